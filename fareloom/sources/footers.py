"""What deliveries store, found from their footers in one distributed job.

Each delivery is a Parquet file or a folder of them. A task reads the footers of its deliveries and
returns a fingerprint of the stored columns for every file, so any number of deliveries is one
job; Spark then infers the schema of one file for each distinct fingerprint, of which there are few.
The footers are opened through Arrow. On a filesystem that Arrow does not know, and for patterns,
Spark infers the schema of one delivery after the other.
"""

import hashlib
import json
from collections.abc import Iterable, Iterator
from pathlib import Path
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.sources.sinks import stage

SURVEY = "delivery string, file string, stored string"
# Schemes that Arrow opens, under the name it knows.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfss": "abfss"}
DELIVERIES_A_TASK = 32


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the filesystem that Spark finds it on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def opened_by_arrow(uri: str) -> bool:
    return urlsplit(uri).scheme in ARROW_SCHEMES and not any(c in uri for c in "*?[{")


def _footers(uri: str) -> Iterator[tuple[str, str]]:
    """(file, fingerprint of its columns) of every data file of a delivery."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    parts = urlsplit(uri)
    store, path = fs.FileSystem.from_uri(f"{ARROW_SCHEMES[parts.scheme]}://{parts.netloc}{quote(parts.path)}")
    found = store.get_file_info(path)
    files = [found] if found.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
    for file in sorted((f for f in files if f.is_file), key=lambda f: f.path):
        below = file.path[len(path) :].split("/") if not found.is_file else []
        if any(name.startswith(("_", ".")) for name in below):
            continue
        with store.open_input_file(file.path) as source:
            schema = pq.ParquetFile(source).schema
        columns = [schema.column(k) for k in range(len(schema.names))]
        stored = sorted((c.path, c.physical_type, str(c.logical_type), c.converted_type, c.max_repetition_level) for c in columns)
        end = file.path[len(path) :]
        yield uri + end, hashlib.md5(json.dumps(stored).encode()).hexdigest()


def survey(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """A row for every file of every delivery: delivery, file, stored (equal for equal columns). A staged table."""
    uris = sorted(qualified(spark, p) for p in paths)
    if all(map(opened_by_arrow, uris)):
        tasks = max(1, -(-len(uris) // DELIVERIES_A_TASK))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for uri in batch.column(0).to_pylist():
                    rows = list(_footers(uri))
                    columns = [[uri] * len(rows), [f for f, _ in rows], [s for _, s in rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["delivery", "file", "stored"])

        # Workers import this package; told here, they find it without --py-files on one machine.
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
        listed = spark.createDataFrame([(u,) for u in uris], "uri string").repartition(tasks)
        found = listed.mapInArrow(run, SURVEY)
    else:
        kinds = ((u, u, spark.read.parquet(u).schema.json()) for u in uris)
        found = spark.createDataFrame(list(kinds), SURVEY)
    return stage(found, "survey")


def stored_schemas(spark: SparkSession, surveyed: DataFrame) -> dict[str, StructType]:
    """The schema, as Spark infers it, of each distinct ``stored`` of a survey."""
    kinds = surveyed.groupBy("stored").agg(F.min("file").alias("file")).collect()
    return {r.stored: spark.read.parquet(r.file).schema for r in kinds}


def file_order(table: DataFrame) -> DataFrame:
    """A scan of a stored table with the place each row has in it, from 1, as ``position``.

    Files follow each other by name, which is the order a sorted table is written in. Only the
    numbers of rows of the files are summed up in one place.
    """
    placed = table.withColumn("__file", F.col("_metadata.file_path")).withColumn("__row", F.col("_metadata.row_index"))
    rows = placed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy("__file").rowsBetween(W.unboundedPreceding, -1))
    files = rows.select("__file", F.coalesce(before, F.lit(0)).alias("__before"))
    position = F.col("__before") + F.col("__row") + 1
    return placed.join(files, "__file").withColumn("position", position.cast("long")).drop("__file", "__row", "__before")
