"""Exact top-k by Hamming distance over 64-bit codes, by incremental multi-index hashing.

Codes are cut into segments, about as many bits each as the number of codes has. A code within
distance d of a query agrees with it in some segment within d / segments. Segments are probed at
radius 0, 1, 2, ..., half of them at a time, and after each step every code up to a known distance
has been met; a query is done when its k-th verified distance is within it, so the answer is exact.

Equal codes are one entry of the index, which lists the smallest ids only as far as a result can
use them, found by partial ranking; a code that many rows share is met once. Queries of equal
code are probed once. The probes of a query are generated from its own row, a bit flipped at a
time, so neither the driver nor a broadcast holds the flips of a radius. Each round writes what it met and goes on with the queries left.

Vectors of another length than a code has bits have no code. Rows without id or code take no part. Repeated rows are candidates of their own, of repeated
query ids one row asks. Ties go to the smaller id. A query never finds rows of its own id.
Empty tables give empty results; further columns take no part.
"""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.sources.sinks import stage

BITS = 64


def sign_code(vector: Column) -> Column:
    """A code of the signs of a vector's 64 components, lowest bit first; null for a null vector or one of another length."""
    bits = [
        F.when(F.get(vector, F.lit(k)) > 0, F.lit((1 << k) - (1 << 64 if k == 63 else 0))).otherwise(F.lit(0).cast("long"))
        for k in range(BITS)
    ]
    return F.when(F.size(vector) == BITS, reduce(lambda a, b: a.bitwiseOR(b), bits))


def segment_widths(codes: int) -> list[int]:
    """Widths of the segments for so many codes: about log2 of their number."""
    count = max(2, min(BITS, round(BITS / max(1.0, math.log2(max(2, codes))))))
    return [BITS // count + (k < BITS % count) for k in range(count)]


def segments(code: str, widths: list[int]) -> list[Column]:
    """Number and value of each segment of a code."""
    out, at = [], 0
    for number, width in enumerate(widths):
        value = F.shiftrightunsigned(F.col(code), at).bitwiseAND(F.lit((1 << width) - 1))
        out.append(F.struct(F.lit(number).alias("segment"), value.alias("value")))
        at += width
    return out


def search_steps(widths: list[int]) -> list[tuple[int, range, int]]:
    """Radius, the segments probed at it, and the distance up to which every code is then met.

    From radius 2 on, where probes are many, half of the segments are probed before the others:
    once the first h of m segments are probed at radius r, and all at r - 1, a code not yet met
    differs in more than r bits in each of the h and in r at least in each other.
    """
    m, out = len(widths), []
    for radius in range(max(widths) + 1):
        if radius >= 2:
            out.append((radius, range(m // 2), m * radius + m // 2 - 1))
        out.append((radius, range(m // 2 if radius >= 2 else 0, m), m * radius + m - 1))
    return out


def probes(asking: DataFrame, widths: list[int], probed: range, radius: int) -> DataFrame:
    """query, segment, value: the ``probed`` segments of each query code with ``radius`` bits flipped, each way once.

    Bits are flipped in ascending order, and each leaves room for those still to come.
    """
    wide = [n for n in probed if radius <= widths[n]]
    if not wide:
        return asking.select("query", F.lit(0).alias("segment"), F.lit(0).cast("long").alias("value")).where(F.lit(False))
    own = F.explode(F.array(*[segments("query", widths)[n] for n in wide])).alias("s")
    rows = asking.select("query", own).select("query", "s.segment", "s.value")
    room, first = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("segment") + 1), F.lit(0)
    for left in range(radius, 0, -1):
        rows = rows.select("query", "segment", "value", F.explode(F.sequence(first, room - left)).alias("bit"))
        rows = rows.withColumn("value", F.col("value").bitwiseXOR(F.expr("shiftleft(1L, bit)")))
        first = F.col("bit") + 1
    return rows.select("query", "segment", "value")


def candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """query, code, rows, distance: the entries of ``index`` that probes meet.

    Spark takes the probes for as few as the queries they are generated from, so a join of its
    choice would gather all of them on the driver and broadcast them.
    """
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code")))
    return asked.hint("merge").join(index, ["segment", "value"]).select("query", "code", "rows", distance.alias("distance"))


def top_k(rows: DataFrame, queries_by: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, distance: the k nearest of every query, nearest first.

    ``rows`` has vec_id and code; ``queries_by`` picks the rows that ask.
    """
    named = rows.select(F.col("vec_id").cast("long"), F.col("code").cast("long")).dropna()
    by_code = W.partitionBy("code").orderBy("vec_id")
    # Of a code's rows a result can need k, after the asking row itself is left out: all rows of
    # the asking id sit on as many places as that id repeats, so places are counted by distinct id.
    ranked = named.groupBy("code", "vec_id").agg(F.count(F.lit(1)).alias("copies"))
    members = stage(
        ranked.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= k + 1).drop("place"), "members"
    )
    codes = members.groupBy("code").agg(F.sum(F.least("copies", F.lit(k))).alias("rows"))
    widths = segment_widths(codes.count())
    index = stage(codes.select("code", "rows", F.explode(F.array(*segments("code", widths))).alias("s")).select("code", "rows", "s.*"), "index")
    queries = stage(named.where(queries_by).groupBy("vec_id").agg(F.min("code").alias("code")).toDF("query_id", "query"), "queries")
    # Rows of the asking id itself do not count; a code is done when k others are near enough.
    own = queries.join(members, (F.col("query") == F.col("code")) & (F.col("query_id") == F.col("vec_id")))
    own = own.groupBy("query").agg(F.max(F.least("copies", F.lit(k))).alias("own"))
    active = stage(queries.select("query").distinct().join(own, "query", "left").na.fill(0, ["own"]), "active")
    met, done = None, []
    steps = search_steps(widths)
    for radius, probed, covered in steps:
        found = candidates(probes(active, widths, probed, radius), index)
        if met is not None:
            found = found.union(met.join(active, "query", "left_semi"))
        found = found.distinct()
        nearer = W.partitionBy("query").orderBy("distance").rangeBetween(W.unboundedPreceding, -1)
        # Codes behind k rows that are nearer, besides the query's own, are never needed.
        found = (
            found.join(active, "query")
            .withColumn("before", F.coalesce(F.sum("rows").over(nearer), F.lit(0)) - F.col("own"))
            .where(F.col("before") < k)
            .select("query", "code", "rows", "distance")
        )
        met = stage(found, "met")
        near = met.where(F.col("distance") <= covered).groupBy("query").agg(F.sum("rows").alias("n"))
        state = active.join(near, "query", "left").withColumn("left", F.coalesce("n", F.lit(0)) - F.col("own") < k)
        if covered == steps[-1][2]:
            done.append(met)
            break
        state = stage(state, "state")
        done.append(met.join(state.where("NOT left"), "query", "left_semi"))
        active = state.where("left").select("query", "own")
        if active.isEmpty():
            break
    nearest = reduce(DataFrame.union, done).select("query", "code", "distance")
    pairs = queries.join(nearest, "query").join(members, "code").where("vec_id != query_id")
    order = W.partitionBy("query_id").orderBy("distance", "vec_id")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k))))
    return (
        pairs.select("query_id", "vec_id", "distance", copies)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "distance")
    )
