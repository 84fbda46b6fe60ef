"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector, less the centre of all, is rotated by a seeded random rotation and kept as one bit
a dimension and two scalars: its length, and how well the bits stand for its direction. The
inner product with a query is estimated from the bits, with a bound on the error that holds with
a probability set by ``epsilon``. In each block the ``FIRST`` * k vectors of the best estimates are
scored on their original components, in double precision; the k-th best of these scores is what
another vector's upper bound has to reach for it to be reranked too.

The queries are matched against all vectors in blocks of bounded size, block against block;
each pair of blocks is one task's work and yields k rows a query at most. Vectors go along in the
type they are stored in: the bounds of one bit a dimension are so wide that a code sent alone would
call for many rows of candidates, each larger than the vector. The centre is one aggregate over all vectors. The driver holds the rotation and the centre.

Vectors that are null, zero, of another length than most, or hold null or non-finite components
take no part, nor do rows without an id. Of repeated query ids one row asks; repeated rows are
candidates of their own. Ties go to the smaller id. Empty tables give empty results; further
columns take no part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.sources.sinks import stage

QUERY_BLOCK = 4096
VECTOR_BLOCK = 4096
STEP = 256
# Vectors scored ahead of the others, as a multiple of k.
FIRST = 16

_VECTOR = pa.list_(pa.float64())
INDEX = "vec_id long, vector {}, code binary, length double, fit double"


def taking_part(vector: Column) -> Column:
    """Whether a vector is not zero and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def valid_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part. Stored floats stay floats; other numbers become doubles."""
    kind = embeddings.schema[vector].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = embeddings.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast(kind).alias("vector")
    ).where(F.col("vec_id").isNotNull() & F.coalesce(taking_part(F.col("vector")), F.lit(False)))
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (usual["d"] if usual else 0))


def rotation(dimensions: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, length from the centre, and inner product of direction and bits."""
    off = (vectors - centre) @ turn
    length = np.linalg.norm(off, axis=1)
    fit = np.abs(off).sum(axis=1) / np.sqrt(off.shape[1]) / np.where(length > 0, length, 1)
    return np.packbits(off > 0, axis=1), length, np.where(length > 0, fit, 1.0)


def estimate(
    queries: np.ndarray, codes: np.ndarray, length: np.ndarray, fit: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries and coded vectors, and the bound on their error."""
    d = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    along = ((queries @ turn).astype(np.float32) @ signs.T) / np.float32(np.sqrt(d))
    about = (queries @ centre)[:, None] + along * (length / fit)
    spread = length * np.sqrt(np.maximum(0, 1 - fit**2)) / fit * epsilon / np.sqrt(max(1, d - 1))
    # The last term covers rounding to single precision.
    return about, np.linalg.norm(queries, axis=1)[:, None] * (spread + 1e-5 * length)


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks()
    return ids, flat.flatten().to_numpy().astype(np.float64).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))


def search_block(
    asking: pa.Table, held: pa.Table, centre: np.ndarray, turn: np.ndarray, k: int, epsilon: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a block its k nearest in a block of vectors: id, their ids, their scores."""
    query_ids, queries = _block(asking)
    ids, vectors = _block(held)
    if not len(ids) or not len(query_ids):
        return
    codes = np.frombuffer(b"".join(held.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
    length, fit = held.column("length").to_numpy(), held.column("fit").to_numpy()
    for start in range(0, len(queries), STEP):
        part = slice(start, start + STEP)
        about, error = estimate(queries[part], codes, length, fit, centre, turn, epsilon)
        own = query_ids[part][:, None] == ids
        upper = np.where(own, -np.inf, about + error)
        several = min(FIRST * k, len(ids))
        likely = np.argpartition(np.where(own, -np.inf, about), len(ids) - several, axis=1)[:, -several:]
        for line, q in enumerate(range(start, start + len(upper))):
            ahead = likely[line][~own[line, likely[line]]]
            reach = np.sort(vectors[ahead] @ queries[q])[-k] if len(ahead) >= k else -np.inf
            wanted = upper[line] >= reach
            wanted[ahead] = True
            near = np.flatnonzero(wanted & ~own[line])
            score = vectors[near] @ queries[q]
            if k < len(near):
                best = score >= np.partition(score, -k)[-k]
                near, score = near[best], score[best]
            best = np.lexsort((ids[near], -score))[:k]
            yield int(query_ids[q]), ids[near[best]], score[best]


def nearest(
    embeddings: DataFrame, queries_by: Column | None = None, k: int = 20, epsilon: float = 3.0, seed: int = 7
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest of every query, nearest first.

    ``queries_by`` picks the rows that ask (by default ids divisible by 20); all rows but those
    of the query's own id are candidates.
    """
    valid = stage(valid_vectors(embeddings), "vectors")
    at = valid.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x"))
    centre = np.array([r.x for r in at.orderBy("at").collect()])
    turn = rotation(len(centre), seed)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, vectors = _block(pa.Table.from_batches([batch]))
            if len(vectors):
                codes, length, fit = encode(vectors, centre, turn)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(fit)],
                    names=["vec_id", "vector", "code", "length", "fit"],
                )

    coded = stage(valid.mapInArrow(index, INDEX.format(valid.schema["vector"].dataType.simpleString())), "codes")
    asking = coded.where(F.col("vec_id") % 20 == 0 if queries_by is None else queries_by)
    asking = stage(asking.select("vec_id", "vector").dropDuplicates(["vec_id"]), "queries")
    query_blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    vector_blocks = max(1, -(-coded.count() // VECTOR_BLOCK))
    deal = F.xxhash64("vec_id", F.monotonically_increasing_id())
    left = asking.withColumn("qb", F.pmod(deal, F.lit(query_blocks))).withColumn(
        "vb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(vector_blocks - 1).cast("long")))
    )
    right = coded.withColumn("vb", F.pmod(deal, F.lit(vector_blocks))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))
    )

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = list(search_block(asked, held, centre, turn, k, epsilon))
        return pa.table(
            {
                "query_id": pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64)),
                "vec_id": pa.array(np.concatenate([i for _, i, _ in found]) if found else [], pa.int64()),
                "score": pa.array(np.concatenate([s for _, _, s in found]) if found else [], pa.float64()),
            }
        )

    found = (
        left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
