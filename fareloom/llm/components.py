"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fareloom.sources.sinks import drop_staged, stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every node of ``links`` with the smallest node it reaches: node, component.

    Alternating large-star and small-star rounds: each node passes its neighbours on to the
    smallest of them, so the number of rounds grows with the logarithm of a component's
    diameter. Both are joins on grouped minima, so a hub costs a partial aggregate and a join
    that adaptive execution splits, never a gathered neighbour list. Each round is written to
    the shared folder and the round before deleted. Links to null or to oneself are ignored;
    an empty table gives an empty result.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "links",
        infer=False,
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours go to the smallest neighbour. Repeated rows go with those of the small star.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: the node and its smaller neighbours go to the smallest of them.
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        state = Observation()
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
        new = stage(small.observe(state, F.count(F.lit(1)).alias("n"), digest), "links", infer=False)
        drop_staged(edges)
        edges = new
        if state.get == before:
            break
        before = state.get
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
