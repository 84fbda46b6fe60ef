"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents with equal shingle sets are one node, so copies are never paired. Shingles are put
into one global order, rarest first. If two nodes link, the first ``l`` shingles they share lie
in the first ``n - required overlap + l`` of each, for every ``l``. Every node lengthens its
prefix (raises its ``l``) as long as that lowers the estimated cost of its candidates, and a
pair is verified only if the prefixes share at least the smaller of the two ``l``.

1. A shingle that only one node has can link nothing, and a node with more of them than a link
   leaves room for has no partner. A quarter of the hash space is counted first; that drops
   the nodes without any partner before the full sets of the others are counted. A node without
   a shingle in that quarter stays.
2. The nodes left take their prefixes from the shingles they share, ordered by frequency.
3. Prefix shingles with the same nodes count once. Nodes of one short list are paired by a
   join. Long lists (large groups of near copies) are never expanded into rows of pairs: the
   nodes they connect are cut into blocks, and each pair of blocks is matched by one task,
   which returns links enough to connect them and the number of links of each node.

Hash buckets hold packed arrays, so that a shingle costs about one hash in a shuffle; their number
grows with the shingles, so that what one task holds does not. A filter
on 64-bit hashes never loses a link; a wrong one needs a collision inside one pair of texts, or
two different sets of equal 64-bit signature.

Nulls, empty texts and texts of white space only have no shingles and link with nothing. Rows
are documents of their own even if ids repeat; a null id is never a component's smallest. An
empty table gives an empty result. Further columns of the input take no part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.llm.components import connected_components
from fareloom.llm.shingles import Powers, mix, shingle_set
from fareloom.sources.sinks import stage

SAMPLED_PART = 4
LONG_LIST = 32
BLOCK_NODES = 256
MATRIX_COLUMNS = 4096
BATCH_SHINGLES = 2_000_000
BUCKET_SHINGLES = 2_000_000

PACKED = "bucket int, tokens binary, nodes binary, sizes binary, runs binary"
PACKED_TYPES = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("tokens", "nodes", "sizes", "runs"))])


def most_unshared(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles of a set of ``n`` a linked set can be without."""
    return n - (percent * n + 99) // 100


def signature(tokens: np.ndarray) -> int:
    """A set's name: equal for equal sets, as a signed 64-bit number."""
    with np.errstate(over="ignore"):
        total = np.bitwise_xor.reduce(mix(tokens)) + mix(tokens + np.uint64(1)).sum(dtype=np.uint64)
    return int(np.int64(mix(np.atleast_1d(total))[0].view(np.int64)))


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, key (hash of the text), n (size of the set), node (its signature; null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            sets = (shingle_set(t.as_py(), width, powers) for t in batch.column(2))
            found = [(len(s), signature(s) if len(s) else None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.int64()),
                ],
                names=["doc_id", "key", "n", "node"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, n long, node long")


def _pack(bucket: int, tokens: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> dict:
    """A row of shingles; nodes and set sizes are stored once a run of one node."""
    first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
    runs = np.diff(np.append(first, len(nodes))).astype(np.uint32)
    return {
        "bucket": bucket,
        "tokens": tokens.tobytes(),
        "nodes": nodes[first].tobytes(),
        "sizes": sizes[first].astype(np.uint32).tobytes(),
        "runs": runs.tobytes(),
    }


def _unpack(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, nodes and set sizes of all rows, one entry a shingle."""

    def joined(name: str, dtype: type) -> np.ndarray:
        return np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype)

    runs = joined("runs", np.uint32)
    return (
        joined("tokens", np.uint64),
        np.repeat(joined("nodes", np.int64), runs),
        np.repeat(joined("sizes", np.uint32), runs).astype(np.int64),
    )


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """An order that puts entries of equal bucket together, and (bucket, start, end) in it."""
    at = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(np.bincount(at, minlength=buckets))
    starts = np.concatenate(([0], ends[:-1]))
    return order, ((b, s, e) for b, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)) if e > s)


def _rows(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, types)


def scatter(texts: DataFrame, width: int, part: int, buckets: int) -> DataFrame:
    """The shingles of every text dealt into buckets of the hash space; 1 of ``part`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen, held, size = Powers(), set(), [], 0

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate([t for t, _, _ in held])
            lengths = [len(t) for t, _, _ in held]
            nodes = np.repeat(np.array([s for _, s, _ in held], np.int64), lengths)
            sizes = np.repeat(np.array([n for _, _, n in held], np.int64), lengths)
            order, parts = _by_bucket(tokens, buckets)
            tokens, nodes, sizes = tokens[order], nodes[order], sizes[order]
            return _rows([_pack(b, tokens[s:e], nodes[s:e], sizes[s:e]) for b, s, e in parts], PACKED_TYPES)

        for batch in batches:
            for text in batch.column(0):
                tokens = shingle_set(text.as_py(), width, powers)
                if not len(tokens) or (node := signature(tokens)) in seen:
                    continue
                seen.add(node)
                # The low bits pick the sample, the high bits the bucket.
                wanted = tokens[tokens % np.uint64(part) == 0] if part > 1 else tokens
                if len(wanted):
                    held.append((wanted, node, len(tokens)))
                    size += len(wanted)
                if size >= BATCH_SHINGLES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return texts.select("text").mapInArrow(run, PACKED)


def _counted(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, node) of a bucket with set sizes, and how many nodes have the token."""
    tokens, nodes, sizes = _unpack(rows)
    order = np.lexsort((nodes, tokens))
    tokens, nodes, sizes = tokens[order], nodes[order], sizes[order]
    new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])))
    tokens, nodes, sizes = tokens[new], nodes[new], sizes[new]
    first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    counts = np.diff(np.append(first, len(tokens)))
    return tokens, nodes, sizes, np.repeat(counts, counts)


def nodes_without_partners(packed: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Nodes with more shingles known to be theirs alone than a link leaves room for: node.

    A node of which no shingle is in ``packed``, as small ones may be, is not known to be one.
    """
    types = pa.schema([("bucket", pa.int32()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("alone", pa.binary())])

    def count(rows: pa.Table) -> pa.Table:
        _, nodes, sizes, having = _counted(rows)
        found, first, back = np.unique(nodes, return_index=True, return_inverse=True)
        alone = np.bincount(back, having == 1).astype(np.uint32)
        sizes = sizes[first].astype(np.uint32)
        order, parts = _by_bucket(mix(found.view(np.uint64)), buckets)
        return pa.Table.from_pylist(
            [
                {
                    "bucket": b,
                    "nodes": found[order[s:e]].tobytes(),
                    "sizes": sizes[order[s:e]].tobytes(),
                    "alone": alone[order[s:e]].tobytes(),
                }
                for b, s, e in parts
            ],
            types,
        )

    def decide(rows: pa.Table) -> pa.Table:
        nodes, sizes, alone = (
            np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)
            for name, kind in (("nodes", np.int64), ("sizes", np.uint32), ("alone", np.uint32))
        )
        found, first, back = np.unique(nodes, return_index=True, return_inverse=True)
        total = np.bincount(back, alone)
        without = total > most_unshared(sizes[first].astype(np.int64), percent)
        return pa.table({"node": pa.array(found[without], pa.int64())})

    counted = packed.groupBy("bucket").applyInArrow(count, "bucket int, nodes binary, sizes binary, alone binary")
    return counted.groupBy("bucket").applyInArrow(decide, "node long")


def choose_matches(having: np.ndarray, alone: int, n: int, percent: int, longest: int = 64) -> int:
    """The ``l`` of least estimated cost for a node.

    ``having`` holds how many nodes have each shingle it shares, in order. A prefix costs one
    list entry for each node met in it. A candidate needs ``l`` meetings, so the entries
    divided by ``l`` estimate the candidates, and verifying one reads the set.
    """
    room = int(most_unshared(np.int64(n), percent)) - alone
    entries = np.concatenate(([0], np.cumsum(having - 1)))
    matches = np.arange(1, max(1, min(longest, len(having) - room, n - n * (100 - percent) // 100)) + 1)
    met = entries[np.minimum(room + matches, len(having))]
    return int(matches[np.argmin(met + met / matches * (n / 8))])


def shared_sets(packed: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Nodes that may link: node, n, matches (their ``l``), prefix, tokens (shingles they share)."""
    types = pa.schema([*PACKED_TYPES, ("having", pa.binary())])
    out = pa.schema(
        [
            ("node", pa.int64()),
            ("n", pa.int64()),
            ("matches", pa.int32()),
            ("prefix", pa.list_(pa.int64())),
            ("tokens", pa.list_(pa.int64())),
        ]
    )

    def count(rows: pa.Table) -> pa.Table:
        tokens, nodes, sizes, having = _counted(rows)
        shared = having > 1
        tokens, nodes, sizes, having = tokens[shared], nodes[shared], sizes[shared], having[shared]
        order = np.argsort(nodes, kind="stable")
        tokens, nodes, sizes, having = tokens[order], nodes[order], sizes[order], having[order]
        order, parts = _by_bucket(mix(nodes.view(np.uint64)), buckets)
        tokens, nodes, sizes, having = tokens[order], nodes[order], sizes[order], having[order]
        return pa.Table.from_pylist(
            [
                _pack(b, tokens[s:e], nodes[s:e], sizes[s:e]) | {"having": having[s:e].astype(np.uint32).tobytes()}
                for b, s, e in parts
            ],
            types,
        )

    def choose(rows: pa.Table) -> pa.Table:
        tokens, nodes, sizes = _unpack(rows)
        having = np.frombuffer(b"".join(rows.column("having").to_pylist()), np.uint32).astype(np.int64)
        order = np.lexsort((tokens, having, nodes))
        tokens, nodes, sizes, having = tokens[order], nodes[order], sizes[order], having[order]
        first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1]))) if len(nodes) else []
        found = []
        for s, e in zip(first, [*first[1:], len(nodes)], strict=True):
            n, alone = int(sizes[s]), int(sizes[s]) - int(e - s)
            room = int(most_unshared(np.int64(n), percent)) - alone
            if room < 0:
                continue
            matches = choose_matches(having[s:e], alone, n, percent)
            found.append(
                {
                    "node": int(nodes[s]),
                    "n": n,
                    "matches": matches,
                    "prefix": tokens[s : min(e, s + room + matches)].view(np.int64),
                    "tokens": np.sort(tokens[s:e].view(np.int64)),
                }
            )
        return pa.Table.from_pylist(found, out)

    counted = packed.groupBy("bucket").applyInArrow(count, PACKED + ", having binary")
    return counted.groupBy("bucket").applyInArrow(
        choose, "node long, n long, matches int, prefix array<bigint>, tokens array<bigint>"
    )


def prefix_lists(sets: DataFrame) -> DataFrame:
    """Prefix shingles that several nodes have, one of those with equal nodes: token, nodes."""
    entries = sets.select("node", F.explode("prefix").alias("token"))
    lists = entries.groupBy("token").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit("again"))).alias("y"),
    )
    return lists.where("nodes > 1").groupBy("nodes", "x", "y").agg(F.min("token").alias("token")).drop("x", "y")


def paired(sets: DataFrame, entries: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Links among nodes of short lists, one row a link: a, b. Pairs of one family are left out."""
    of = entries.where(F.col("nodes") <= LONG_LIST).join(families, "node", "left")
    of = of.select("token", "node", "n", "family")
    left, right = of.toDF("token", "a", "na", "fa"), of.toDF("token", "b", "nb", "fb")
    pairs = (
        left.join(right, "token")
        .where("a < b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .where(F.coalesce(F.col("fa") != F.col("fb"), F.lit(True)))
        .select("a", "b")
        .distinct()
    )
    short = sets.select("node", "matches", "prefix")
    matched = (
        pairs.join(short.toDF("a", "la", "pa"), "a")
        .join(short.toDF("b", "lb", "pb"), "b")
        .where(F.size(F.array_intersect("pa", "pb")) >= F.least("la", "lb"))
        .select("a", "b")
    )
    whole = sets.select("node", "n", "tokens")
    common = F.size(F.array_intersect("ta", "tb"))
    return (
        matched.join(whole.toDF("a", "na", "ta"), "a")
        .join(whole.toDF("b", "nb", "tb"), "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
        .select("a", "b")
    )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each array of ``left`` shares with each of ``right``."""
    flat = np.concatenate([*left, *right]) if left or right else np.zeros(0, np.int64)
    _, code = np.unique(flat, return_inverse=True)
    line = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    order = np.argsort(code, kind="stable")
    code, line = code[order], line[order]
    out = np.zeros((len(left), len(right)), np.float32)
    top = int(code[-1]) + 1 if len(code) else 0
    for start in range(0, top, MATRIX_COLUMNS):
        s, e = np.searchsorted(code, (start, start + MATRIX_COLUMNS))
        ones = np.zeros((len(left) + len(right), MATRIX_COLUMNS), np.float32)
        ones[line[s:e], code[s:e] - start] = 1
        out += ones[: len(left)] @ ones[len(left) :].T
    return out.astype(np.int64)


def _verified(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many numbers the sorted array ``x`` shares with each of ``others``."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
    ends = np.cumsum([len(o) for o in others])
    return np.diff(np.concatenate(([0], np.cumsum(x[at] == flat)[ends - 1])))


def match_blocks(rows: pa.Table, percent: int) -> list[dict]:
    """All links of one pair of blocks: for each linked node the node it hangs on, and its links."""
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    block = rows.column("block").to_numpy()
    node, n, copies, matches = (rows.column(c).to_numpy() for c in ("node", "n", "copies", "matches"))
    prefix, tokens = ([x.values.to_numpy() for x in rows.column(c)] for c in ("prefix", "tokens"))
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    near = 100 * np.minimum(n[left][:, None], n[right]) >= percent * np.maximum(n[left][:, None], n[right])
    near &= (node[left][:, None] < node[right]) if i == j else True
    near &= _overlaps([prefix[k] for k in left], [prefix[k] for k in right]) >= np.minimum(
        matches[left][:, None], matches[right]
    )
    root = np.arange(len(node))
    links = np.zeros(len(node), np.int64)

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for x, line in zip(left.tolist(), near, strict=True):
        if not line.any():
            continue
        ys = right[line]
        common = _verified(tokens[x], [tokens[y] for y in ys])
        ys = ys[100 * common >= percent * (n[x] + n[ys] - common)]
        links[x] += copies[ys].sum()
        links[ys] += copies[x]
        for y in ys.tolist():
            root[top(y)] = top(x)
    return [
        {"a": int(node[k]), "b": int(node[top(k)]), "links": int(links[k])} for k in np.flatnonzero(links).tolist()
    ]


def family_links(sets: DataFrame, families: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    """Links inside families, matched block against block: a, b (a node it hangs on), links (of a)."""
    sizes = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("blocks"))
    cells = (
        families.join(sizes, "family")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "family",
            "block",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
        )
        .join(copies, "node")
        .join(sets, "node")
    )

    def run(rows: pa.Table) -> pa.Table:
        types = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
        return pa.Table.from_pylist(match_blocks(rows, percent), types)

    return cells.groupBy("family", "i", "j").applyInArrow(run, "a long, b long, links long")


def bucket_count(partitions: int, shingles: int) -> int:
    """Buckets of the hash space: the shuffle partitions, and one for every ``BUCKET_SHINGLES`` shingles."""
    return max(16, partitions, -(-shingles // BUCKET_SHINGLES))


def document_classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """A row a document: doc_id, key (hash of its text), n, class (null if empty), n_links."""
    spark = docs.sparkSession
    known = stage(document_sets(docs, width), "sets")
    # Copies within one task are dealt once, so this is an upper bound.
    shingles = known.agg(F.sum("n")).first()[0] or 0
    buckets = bucket_count(int(spark.conf.get("spark.sql.shuffle.partitions")), shingles)
    nodes = known.where("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("key")
    )
    lonely = nodes_without_partners(scatter(docs, width, SAMPLED_PART, buckets), percent, buckets)
    left = stage(nodes.join(lonely, "node", "left_anti"), "nodes")
    # The same join at every size: a broadcast would only suit few nodes.
    wanted = left.select("key").hint("merge")
    texts = docs.select(F.xxhash64("text").alias("key"), "text").join(wanted, "key", "left_semi")
    sets = stage(shared_sets(scatter(texts, width, 1, buckets), percent, buckets), "shared")

    lists = stage(prefix_lists(sets), "lists")
    entries = sets.select("node", "n", F.explode("prefix").alias("token")).join(lists, "token")
    long_lists = entries.where(F.col("nodes") > LONG_LIST)
    families = connected_components(
        long_lists.join(long_lists.groupBy("token").agg(F.min("node").alias("least")), "token").select("node", "least"),
        "node",
        "least",
    ).select("node", F.col("component").alias("family"))
    copies = left.select("node", "copies")
    short = stage(paired(sets, entries, families, percent), "links")
    inside = stage(family_links(sets, families, copies, percent), "links")

    classes = connected_components(short.union(inside.select("a", "b")))
    weight = copies.withColumnRenamed("node", "b")
    both = short.union(short.select("b", "a")).toDF("a", "b")
    links = (
        both.join(weight, "b")
        .select("a", F.col("copies").alias("links"))
        .union(inside.select("a", "links"))
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("links").alias("links"))
    )
    found = nodes.join(classes, "node", "left").join(links, "node", "left").select(
        "node",
        F.coalesce("component", "node").alias("class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return known.join(found, "node", "left")


def jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, n_links.

    Two documents link if 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles. component_id is the smallest doc_id reachable by links, the
    document's own included; n_links counts the other documents it links with directly.
    """
    rows = document_classes(docs, width, percent)
    least = rows.groupBy("class").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_class(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of every near-duplicate class, that of the smallest doc_id.

    Documents without shingles all stay. A null doc_id comes after all others; of several texts of
    the smallest doc_id that of the smallest hash stays, and of repeated rows of it one does.
    """
    key, order = F.xxhash64("text"), W.partitionBy("__id", "__key").orderBy("__key")
    found = document_classes(docs, width, percent)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("pick")
    picked = found.where("class IS NOT NULL").groupBy("class").agg(pick).select("pick.doc_id", "pick.key", F.lit(False))
    empty = found.where("class IS NULL").select("doc_id", "key", F.lit(True))
    kept = picked.union(empty).toDF("doc_id", "__key", "__empty")
    kept = kept.select(F.xxhash64("doc_id").alias("__id"), "__key", "__empty")
    rows = docs.withColumns({"__id": F.xxhash64(F.col("doc_id").cast("long")), "__key": key})
    return (
        rows.join(kept.distinct(), ["__id", "__key"])
        .withColumn("__place", F.row_number().over(order))
        .where(F.col("__empty") | (F.col("__place") == 1))
        .drop("__id", "__key", "__empty", "__place")
    )
