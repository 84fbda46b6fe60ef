"""What several operators of this subpackage share: words, folds, and tables read by name."""

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers are told where this package lies."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for a null."""
    parts = F.split(F.trim(F.regexp_replace(text, WHITE, " ")), " ")
    return F.when(F.coalesce(F.trim(F.regexp_replace(text, WHITE, " ")), F.lit("")) == "", 0).otherwise(
        F.size(parts)
    ).cast("long")


def in_fold(doc_id: Column, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` modulo 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == remainder, F.lit(False))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns that clash with names an operator adds, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def labelled(labels: DataFrame, label: str, remainder: int) -> DataFrame:
    """One label a document from the rows outside the held-out fold: doc_id, label.

    Rows without an id or label are left out; of conflicting rows the larger label counts.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~in_fold(F.col("doc_id"), remainder))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
