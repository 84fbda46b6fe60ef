"""Mixing sources to target weights by capped water-filling, and seeded repetition of documents.

Targets: a budget of words is shared by weight; a source whose share exceeds its largest number
of epochs is clamped there and the excess shared by weight among the others, until none is
above. Repetition: every document of a source is taken as often as the target holds the whole
source, and the fraction left is filled with documents in seeded order, the last of them in part.

The order is that of a digest of seed and doc_id, so reruns agree. The running total that ends
it is taken over 4,096 slices of the digest first, then over the documents of one slice, so no
task holds a source whatever its share of the rows.

A null source is a source of its own, after all others. Documents without words (nulls
included) have size 0 and are never taken. Rows that repeat are documents of their own. Empty
tables give empty results; further columns are kept, and those named like an added one replaced.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fareloom.llm.common import WORD, without
from fareloom.sources.sinks import stage

ADDED = ("size", "source_size", "target", "taken")
SLICE_DIGITS = 3


def source_key(source: Column) -> Column:
    """A key that sorts by code point, the null source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def ranked(sources: DataFrame, by: str) -> DataFrame:
    """``sources`` with ``rank`` from 0 in the order of ``by``, found without gathering the rows."""
    sorted_rows = stage(sources.orderBy(by).withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    before = (
        sorted_rows.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(W.orderBy("part")) - F.col("n"))
    )
    return sorted_rows.join(before, part == F.col("part")).withColumn(
        "rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("at", "part", "n", "before")


def fill(sources: DataFrame, words: float, most_epochs: int) -> DataFrame:
    """``sources`` (size, weight) with ``target``; each round is one aggregate over the sources."""
    cap = F.col("source_size") * most_epochs
    level = 0.0
    while True:
        clamped = cap <= F.col("weight") * F.lit(level)
        given, free = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0)), F.sum(F.when(clamped, 0).otherwise(F.col("weight")))
        ).first()
        if not free:
            break
        raised = (words - given) / free
        if raised <= level:
            break
        level = raised
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(cap <= share, cap.cast("double")).otherwise(share))


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most_epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """``docs`` with size, source_size, target (of its source) and taken, all in words.

    ``weights`` repeat over the sources in the order of their names. The budget is ``share`` of
    all words. A document is taken ``taken / size`` times; only the last of a source's seeded
    order can be taken by a fraction, so that a source meets its target to the word.
    """
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    columns = without(docs, ADDED).columns
    rows = without(docs, ADDED).withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "__source": source_key(F.col("source")),
            "__digest": digest,
            "__slice": F.substring(digest, 1, SLICE_DIGITS),
        }
    )
    slices = stage(rows.groupBy("__source", "__slice").agg(F.sum("size").alias("words")), "slices")
    sources = ranked(slices.groupBy("__source").agg(F.sum("words").alias("source_size")), "__source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stage(sources.withColumn("weight", weight), "weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = fill(sources, share * total, most_epochs)

    wanted = F.floor(F.col("target") + 0.5)
    size = F.greatest("source_size", F.lit(1))
    plan = filled.withColumns({"__whole": F.floor(wanted / size), "__extra": wanted % size}).drop("rank", "weight")
    running = W.partitionBy("__source").orderBy("__slice").rowsBetween(W.unboundedPreceding, 0)
    ends = (
        slices.withColumn("before", F.sum("words").over(running) - F.col("words"))
        .join(plan.select("__source", "__extra"), "__source")
        .where((F.col("before") < F.col("__extra")) & (F.col("before") + F.col("words") >= F.col("__extra")))
        .select("__source", F.col("__slice").alias("__end"), F.col("before").alias("__before"))
    )
    plan = stage(plan.join(ends, "__source", "left"), "plan")

    planned = rows.join(plan, "__source")
    inside = F.coalesce(F.col("__slice") == F.col("__end"), F.lit(False))
    apart = planned.where(~inside).withColumn(
        "__more", F.when(F.col("__slice") < F.col("__end"), F.col("size")).otherwise(0)
    )
    order = W.partitionBy("__source").orderBy("__digest", "doc_id", "size")
    until = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    left = F.col("__extra") - F.col("__before") - (until - F.col("size"))
    last = planned.where(inside).withColumn("__more", F.greatest(F.lit(0), F.least("size", left)))
    out = reduce(DataFrame.unionByName, (apart, last))
    taken = (F.col("__whole") * F.col("size") + F.col("__more")).cast("long")
    return out.select(*[F.col(f"`{c}`") for c in columns], "size", "source_size", "target", taken.alias("taken"))


def repeat(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, without the columns of ``mix``.

    The fraction of a document is its first words, joined by spaces.
    """
    whole, part = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    texts = F.concat(
        F.array_repeat("text", whole.cast("int")),
        F.when(
            part > 0, F.array(F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, part.cast("int")), " "))
        ).otherwise(F.array().cast("array<string>")),
    )
    names = without(mixed, ADDED).columns
    rows = mixed.where("taken > 0").select(
        *[F.col(f"`{c}`") for c in names if c != "text"], F.explode(texts).alias("text")
    )
    return rows.select(*[F.col(f"`{c}`") for c in names])
