"""Ranked lexical search with K2-treaps: the best documents for each of many items, by integer impacts.

Documents are cut into blocks inside the tasks that read them. A block is a grid of terms by documents
whose cells hold impacts. It is stored as a compressed quadtree: every level has, for its non-empty
quadrants alone, which of the four parts are non-empty (bits of a byte) and the largest impact below, as
the difference from the quadrant above. Terms are ordered by how many documents have them, then by the
first of these, so that filled cells lie together.

An item is a set of weighted rows. Their paths descend the tree together, over one range of documents at
a time: the weighted sum of the quadrants' maxima bounds the score of every document in the range. Ranges
are taken best first, in batches of neighbours in that order; those that cannot reach the item's k-th
score so far are left out, and a range of one document has its exact score. A task carries the scores
found from block to block, and what the tasks found is ranked.

The index holds every document with a term. Items are searched in batches of bounded size, as many as
there are, each a pass over the index. Nothing else passes through the driver but the sizes of the corpus.

Terms are runs of letters, digits and anything beyond ASCII, A-Z in lower case, compared by 64-bit hash.
A null or empty text, or one without terms, has none: such a document is not ranked, such an item gets
no rows. Every row of the documents is a document of its own; among equal scores the smaller doc_id comes
first, a null one last. Rows equal in item_id and text count once; rows of one item_id with other texts
are one item with the terms of all; a null item_id is an id like any other. Empty tables give empty
results. Other columns are not read. Long texts are cut into terms piece by piece; a block of a single
document may be larger than others.
"""

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.llm.shingles import Powers, mix
from fareloom.sources.readers import load_from_parquet
from fareloom.sources.sinks import drop_staged, new_folder, stage

# Terms and documents after which a block ends, and bytes of text that are cut at a time.
BLOCK_TERMS, BLOCK_DOCS, PIECE = 1 << 21, 1 << 12, 1 << 21
# Ranges that are expanded at a time, and terms of items searched in one pass.
BATCH, PASS_TERMS = 256, 1 << 20
# Blocks in a row group, so that a reader holds few at a time.
ROW_GROUP = 4

_TERM = np.ones(256, bool)
_TERM[:0x80] = False
_LOWER = np.arange(256, dtype=np.uint64)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _TERM[ord(_low) : ord(_high) + 1] = True
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)
# How many of the four parts a byte of bits has, and how many come before each of them.
_PARTS = np.array([m.bit_count() for m in range(16)], np.uint8)
_EARLIER = np.array([[(m & (1 << q) - 1).bit_count() for q in range(4)] for m in range(16)], np.uint8).ravel()
_PRESENT = np.array([[m >> q & 1 for q in range(4)] for m in range(16)], np.uint8).ravel()

INDEX = (
    "n_docs int, doc_ids binary, unnamed binary, terms binary, rows binary, df binary, height int, top long, "
    "sizes binary, masks binary, drops binary"
)
TERMS = "item_id long, term long, n long"


@dataclass(frozen=True)
class Corpus:
    """Documents that have a term, and the terms of all with repeats."""

    docs: int
    terms: int


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins, with the end of the last."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), edges


def _pieces(data: np.ndarray, edges: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, edges) of consecutive pieces of about ``size`` bytes. Only long texts are cut, between terms."""
    docs, at, held = [], [], 0
    for doc, (start, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        while start < end:
            stop = end
            if end - start > size:
                stop = start + size
                while stop < end and _TERM[data[stop]]:
                    part = _TERM[data[stop : min(end, stop + size)]]
                    stop += len(part) if part.all() else int(np.argmin(part))
            docs.append(doc)
            at.append(start)
            held += stop - start
            start = stop
            if held >= size:
                yield np.array(docs), np.array([*at, stop])
                docs, at, held = [], [], 0
    if docs:
        yield np.array(docs), np.array([*at, int(edges[-1])])


def _terms(data: np.ndarray, edges: np.ndarray, powers: Powers, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of all terms, a piece of text at a time."""
    for docs, cuts in _pieces(data, edges, size):
        own, cuts = data[cuts[0] : cuts[-1]], cuts - cuts[0]
        inside = _TERM[own]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[cuts[:-1]], last[cuts[1:] - 1] = inside[cuts[:-1]], inside[cuts[1:] - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = powers.upto(len(own))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(own) + 1, np.uint64)
            np.cumsum((_LOWER[own] + np.uint64(1)) * up[: len(own)], out=sums[1:])
            hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        yield docs[np.searchsorted(cuts, starts, "right") - 1], hashes


def corpus_of(docs: DataFrame) -> Corpus:
    """How many documents have a term, and how many terms they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, edges = _texts(batch.column(0))
            n = np.zeros(len(edges) - 1, np.int64)
            for own, cuts in _pieces(data, edges, PIECE):
                inside = _TERM[data[cuts[0] : cuts[-1]]]
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                begin = cuts[:-1] - cuts[0]
                first[begin] = inside[begin]
                n += np.bincount(own, np.add.reduceat(first, begin, dtype=np.int64), len(n)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"docs": pa.array([int((n > 0).sum())]), "terms": pa.array([int(n.sum())])})

    sizes = docs.select("text").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return Corpus(sizes[0] or 0, sizes[1] or 0)


def _spread(x: np.ndarray) -> np.ndarray:
    """The 32 low bits of each number, with a zero before each."""
    x = x.astype(np.uint64)
    for shift, kept in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(kept)
    return x


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def block(ids: np.ndarray, unnamed: np.ndarray, docs: np.ndarray, hashes: np.ndarray, corpus: Corpus) -> dict:
    """The index row of a block: the terms (document, hash) of the documents with these ids."""
    terms, term = np.unique(hashes, return_inverse=True)
    cells, tf = np.unique(docs * np.int64(len(terms)) + term, return_counts=True)
    doc, term = cells // len(terms), cells % len(terms)
    # In whole numbers of any size, as their product may pass 64 bits.
    m = np.array([75 + 25 * n * corpus.docs // corpus.terms for n in np.bincount(docs, minlength=len(ids)).tolist()], np.int64)
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
    df = np.bincount(term, minlength=len(terms))
    first = np.full(len(terms), len(ids))
    np.minimum.at(first, term, doc)
    rows = np.empty(len(terms), np.int64)
    rows[np.lexsort((first, -df))] = np.arange(len(terms))

    height = max(1, (len(terms) - 1).bit_length(), (len(ids) - 1).bit_length())
    place = _spread(rows[term]) << np.uint64(1) | _spread(doc)
    order = np.argsort(place)
    place, most = place[order], impact[order]
    masks, drops, sizes = [], [], [len(place)]
    for _ in range(height):
        above = place >> np.uint64(2)
        starts = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        masks.append(np.bitwise_or.reduceat(np.left_shift(1, (place & np.uint64(3)).astype(np.uint8)).astype(np.uint8), starts))
        highest = np.maximum.reduceat(most, starts)
        drops.append((np.repeat(highest, np.diff(np.append(starts, len(place)))) - most).astype(np.uint32))
        place, most = above[starts], highest
        sizes.append(len(place))
    return {
        "n_docs": len(ids),
        "doc_ids": ids.astype(np.int64).tobytes(),
        "unnamed": unnamed.tobytes(),
        "terms": terms.tobytes(),
        "rows": rows.astype(np.uint32).tobytes(),
        "df": df.astype(np.uint32).tobytes(),
        "height": height,
        "top": int(most[0]),
        "sizes": np.array(sizes[::-1], np.int64).tobytes(),
        "masks": _packed(np.concatenate(masks[::-1])),
        "drops": _packed(np.concatenate(drops[::-1])),
    }


def build_index(docs: DataFrame, corpus: Corpus, block_terms: int = BLOCK_TERMS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a block of documents, written to the shared folder. No row is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, ids, unnamed, n_terms = Powers(), [], [], [], 0
        schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in INDEX.split(", "))])

        def ended() -> pa.RecordBatch:
            row = block(np.array(ids), np.array(unnamed, bool), *(np.concatenate(x) for x in zip(*held, strict=True)), corpus)
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            data, edges = _texts(batch.column(1))
            named = batch.column(0).to_pylist()
            own = np.full(len(named), -1)
            for doc, hashes in _terms(data, edges, powers):
                # A piece ends between documents unless it is of one; a block ends where a document does.
                while len(doc):
                    at = np.flatnonzero(np.diff(doc, prepend=-1))
                    room = max(0, block_docs - len(ids))
                    known = own[doc[0]] >= 0
                    fresh = at[int(known) :]
                    full = np.searchsorted(n_terms + fresh, block_terms)
                    stop = min(full, room)
                    end = int(fresh[stop]) if stop < len(fresh) else len(doc)
                    if end == 0 or (not known and not room):
                        yield ended()
                        held, ids, unnamed, n_terms = [], [], [], 0
                        continue
                    for d in doc[fresh[:stop]].tolist():
                        own[d] = len(ids)
                        ids.append(0 if named[d] is None else named[d])
                        unnamed.append(named[d] is None)
                    held.append((own[doc[:end]], hashes[:end]))
                    n_terms += end
                    doc, hashes = doc[end:], hashes[end:]
        if held:
            yield ended()

    path = new_folder(docs.sparkSession, "treaps")
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)
    rows.write.option("parquet.block.row.count.limit", ROW_GROUP).parquet(path)
    return load_from_parquet(docs.sparkSession, path)


class Treap:
    """A block, unpacked. Node 0 stands for every empty quadrant, node 1 for the whole grid."""

    def __init__(self, row: dict) -> None:
        self.height, self.n_docs = row["height"], row["n_docs"]
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.unnamed = np.frombuffer(row["unnamed"], bool)
        self.terms, self.rows = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["rows"], np.uint32).astype(np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64)
        inner = int(sizes[:-1].sum())
        self.masks = np.zeros(1 + int(sizes.sum()), np.uint8)
        self.masks[1 : 1 + inner] = _unpacked(row["masks"], np.uint8, inner)
        parts = _PARTS[self.masks[1 : 1 + inner]].astype(np.int64)
        # Nodes are in order of levels, so the parts of one come after those of all before it.
        self.first = np.zeros(1 + inner, np.int64)
        self.first[1:] = 2 + np.cumsum(parts) - parts
        self.first = np.concatenate([self.first, np.zeros(len(self.masks) - 1 - inner, np.int64)])
        drops = _unpacked(row["drops"], np.uint32, int(sizes[1:].sum()))
        self.most = np.zeros(len(self.masks), np.int64)
        self.most[1] = row["top"]
        node, child = 1, 2
        for size, below in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True):
            above = np.repeat(self.most[node : node + size], parts[node - 1 : node - 1 + size])
            self.most[child : child + below] = above - drops[child - 2 : child - 2 + below]
            node, child = node + size, child + below

    def rows_of(self, terms: np.ndarray) -> np.ndarray:
        """Row of each term, -1 where the block lacks it."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        return np.where(self.terms[at] == terms, self.rows[at], -1)

    def part(self, nodes: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The given quarter of each node, 0 where it is empty."""
        at = self.masks[nodes].astype(np.int64) * 4 + quarter
        return (self.first[nodes] + _EARLIER[at]) * _PRESENT[at]

    def whole_rows(self, rows: np.ndarray) -> tuple[int, np.ndarray]:
        """The level at which a quadrant is as wide as the block, and each row's node there."""
        level = self.height - (self.n_docs - 1).bit_length()
        nodes = np.where(rows >= 0, 1, 0)
        for step in range(level):
            nodes = self.part(nodes, (rows >> self.height - 1 - step & 1) * 2)
        return level, nodes

    def search(self, level: int, nodes: np.ndarray, rows: np.ndarray, weights: np.ndarray, best: "Best") -> None:
        """Add to ``best`` what this block has for an item of such rows, with their nodes at ``level``."""
        count = 0
        queue = [(0, 0, level, np.zeros(1, np.int64), nodes[None, :], self.most[nodes] @ weights * np.ones(1, np.int64))]
        while queue:
            _, _, level, ranges, nodes, bounds = heapq.heappop(queue)
            # Equal to the k-th is enough, as the smaller id may be here.
            kept = bounds >= best.least
            if not kept.all():
                ranges, nodes, bounds = ranges[kept], nodes[kept], bounds[kept]
            if not len(ranges):
                continue
            if level == self.height:
                best.add(bounds, self.ids[ranges], self.unnamed[ranges])
                continue
            bit = (rows >> self.height - 1 - level & 1) * 2
            halves = [self.part(nodes, bit + half) for half in (0, 1)]
            nodes = np.concatenate(halves)
            bounds = self.most[nodes] @ weights
            ranges = np.concatenate([ranges * 2, ranges * 2 + 1])
            order = np.argsort(-bounds, kind="stable")
            order = order[: np.searchsorted(-bounds[order], -best.least, "right")]
            for start in range(0, len(order), BATCH):
                own, count = order[start : start + BATCH], count + 1
                heapq.heappush(queue, (-int(bounds[own[0]]), count, level + 1, ranges[own], nodes[own], bounds[own]))


class Best:
    """The k best documents of an item so far; ``least`` is the lowest score that may still be among them."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.scores, self.ids, self.unnamed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores, ids, unnamed = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.unnamed, unnamed)))
        order = np.lexsort((ids, unnamed, -scores))[: self.k]
        self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of every item and how often it has them: item_id, term, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for doc, hashes in _terms(*_texts(batch.column(1)), powers):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(hashes.view(np.int64)), pa.array(np.ones(len(doc), np.int64))],
                    names=["item_id", "term", "n"],
                )

    rows = items.select(F.col("item_id").cast("long"), "text").distinct().mapInArrow(run, TERMS)
    return rows.groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def _document_counts(index: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """In how many documents each of the wanted terms (sorted) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                terms, df = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["df"], np.uint32)
                at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                total += np.where(terms[at] == wanted, df[at], 0)
        met = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)[met]), pa.array(total[met])], names=["term", "df"])

    counts = index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in counts.collect()}


def _passes(terms: DataFrame, most: int) -> Iterator[list]:
    """Rows of ``terms``, whole items together, in lists of about ``most`` or of one item."""
    total = terms.count()
    passes = max(1, -(-total // most))
    for k in range(passes if total else 0):
        yield terms.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).collect()


def _weights(rows: list, df: dict[int, int], corpus: Corpus) -> np.ndarray:
    """How much each term of an item weighs, its repeats included."""
    # How rarity weighs.
    rarity = (math.floor(1000 * math.log((2 * corpus.docs + 2) / (2 * df.get(r.term, 0) + 1))) for r in rows)
    return np.array([w * r.n for w, r in zip(rarity, rows, strict=True)], np.int64)


def _search_pass(index: DataFrame, rows: list, corpus: Corpus, k: int) -> DataFrame:
    """item_id, doc_id, score: what each task finds for the items whose terms ``rows`` are."""
    rows = sorted(rows, key=lambda r: (r.item_id is None, r.item_id))
    terms = np.array([r.term for r in rows], np.int64).view(np.uint64)
    wanted, term = np.unique(terms, return_inverse=True)
    weight = _weights(rows, _document_counts(index, wanted), corpus)
    ids = list(dict.fromkeys(r.item_id for r in rows))
    number = {item: i for i, item in enumerate(ids)}
    edges = np.searchsorted([number[r.item_id] for r in rows], np.arange(len(ids) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in ids]
        for batch in batches:
            for row in batch.to_pylist():
                treap = Treap(row)
                places = treap.rows_of(wanted)
                level, nodes = treap.whole_rows(places)
                for start, end, held in zip(edges[:-1], edges[1:], best, strict=True):
                    own = term[start:end]
                    here = nodes[own] > 0
                    if here.any():
                        treap.search(level, nodes[own][here], places[own][here], weight[start:end][here], held)
        for item_id, held in zip(ids, best, strict=True):
            if len(held.ids):
                columns = [
                    pa.array([item_id] * len(held.ids), pa.int64()),
                    pa.array(held.ids, pa.int64(), mask=held.unnamed),
                    pa.array(held.scores, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, corpus: Corpus, k: int = 20, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` best documents of every item (item_id, text)."""
    terms = stage(item_terms(items), "item_terms")
    found = [_search_pass(index, rows, corpus, k) for rows in _passes(terms, pass_terms) if rows]
    none = index.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.union, found, none).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = stage(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")
    drop_staged(terms)
    return out


def search_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``search`` over an index of ``docs`` made for it, and deleted after it."""
    corpus = corpus_of(docs)
    index = build_index(docs, corpus)
    out = search(index, items, corpus, k)
    drop_staged(index)
    return out
