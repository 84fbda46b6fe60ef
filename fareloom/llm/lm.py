"""LM scoring by deleted interpolation over n-grams, bigrams unless ``order`` says otherwise.

A token's probability mixes ``order`` + 1 estimates: for every length below ``order`` its share
among the tokens after that many words before it, down to its share of all tokens, and one over
the vocabulary and one. The weights of the mixture depend on the longest run of words before it
that training has, and on how often it occurs (in buckets, powers of two). They are learned by
expectation-maximisation on a fifth of the training documents, with counts that leave those
documents out; scores then use the counts of all training documents.

Counting: texts become numbered words once, in chunks of bounded size stored in the shared
folder. A chunk asks for the counts of its distinct n-grams of every length, by 64-bit hash, in
buckets of the hash space; the answers come back in the order asked, so a count costs a byte or
two. A frequent word is one entry a chunk, whatever its share of the text. Buckets grow in number
with the tokens, so that what one task holds does not. The driver holds the weights, and a
histogram of held-out tokens of bounded size.

Nulls are empty texts, which have one token, their end. Without training documents the mixture
is uniform. Repeated rows are documents of their own; a null id is never held out. Empty tables
give empty results; further columns take no part.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import in_fold
from fareloom.llm.shingles import Powers, mix, word_hashes
from fareloom.sources.sinks import stage

# Remainders of crc32(doc_id) modulo 5: documents never learned from, and those weights are learned on.
HELD_OUT = 1
FOR_WEIGHTS = 0
MAIN, WEIGHING, OUTSIDE = 0, 1, 2

START, END = np.uint64(0x5374617274), np.uint64(0x456E64)
CHUNK_TOKENS = 1_500_000
BUCKET_TOKENS = 4_000_000
# A kind of n-gram is named by its length; contexts of up to 2 ** 64 occurrences have 65 buckets.
WORDS = 1
CONTEXTS = 65
# The histogram's bins: quarters of a power of two, of probabilities down to 2 ** -60.
BINS_A_BIT, LEAST_BIT = 4, 60

CHUNKS = "chunk long, doc_ids array<bigint>, folds binary, lengths binary, tokens binary, words binary"
ASKED = "bucket int, kind int, chunk long, hashes binary, main binary, weighing binary"
ANSWERS = "chunk long, kind int, bucket int, main binary, weighing binary, vocabulary long"

_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _types(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(", "))])


def tokenise(docs: DataFrame) -> DataFrame:
    """Documents in chunks: ids, folds, tokens of each (its end included) as numbers of words.

    Words are numbered by frequency, so that their numbers compress well; the last token of a
    document is the number of its end, and a chunk lists the hash of every number.
    """
    fold = (
        F.when(in_fold(F.col("doc_id"), HELD_OUT), OUTSIDE)
        .when(in_fold(F.col("doc_id"), FOR_WEIGHTS), WEIGHING)
        .otherwise(MAIN)
    )
    rows = docs.select(F.col("doc_id").cast("long"), fold.alias("fold"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0

        def chunk() -> pa.RecordBatch:
            lengths = np.array([len(w) + 1 for _, _, w in held], np.uint32)
            flat = np.concatenate([x for _, _, w in held for x in (w, [END])]).astype(np.uint64)
            words, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order))
            row = {
                "chunk": uuid.uuid4().int >> 65,
                "doc_ids": [i for i, _, _ in held],
                "folds": bytes(f for _, f, _ in held),
                "lengths": lengths.tobytes(),
                "tokens": pa.compress(number[back].tobytes(), codec="zstd", asbytes=True),
                "words": words[order].tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], _types(CHUNKS))

        for batch in batches:
            for doc_id, fold, text in zip(*batch.columns, strict=True):
                words = word_hashes((text.as_py() or "").encode(), powers)
                held.append((doc_id.as_py(), fold.as_py(), words))
                size += len(words) + 1
                if size >= CHUNK_TOKENS:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    return rows.mapInArrow(run, CHUNKS)


class Chunk:
    """The numpy arrays of one chunk: for each length its distinct n-grams sorted by hash, and each token's place."""

    def __init__(self, row: dict, order: int = 2):
        self.doc_ids = row["doc_ids"]
        self.folds = np.frombuffer(row["folds"], np.uint8)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        data = pa.decompress(row["tokens"], int(self.lengths.sum()) * 4, codec="zstd", asbytes=True)
        self.tokens = np.frombuffer(data, np.uint32)
        words = np.frombuffer(row["words"], np.uint64)
        self.fold = np.repeat(self.folds, self.lengths)
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        hashes = words[self.tokens]
        # Words, with the start as one more, which is counted once a document.
        by_hash = np.argsort(mix(words), kind="stable")
        place = np.empty(len(by_hash), np.int64)
        place[by_hash] = np.arange(len(by_hash))
        self.grams = {WORDS: (mix(words)[by_hash], place[self.tokens])}
        ending = hashes
        for length in range(2, order + 1):
            before = np.empty_like(ending)
            before[1:] = ending[:-1]
            before[starts] = START
            with np.errstate(over="ignore"):
                ending = mix(mix(before) * np.uint64(0x9E3779B97F4A7C15) + hashes)
            self.grams[length] = np.unique(ending, return_inverse=True)
        self.starts = starts

    def asked(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Kind, hashes and how often each occurs in main and weighing documents."""
        for kind, (hashes, at) in self.grams.items():
            main, weighing = (np.bincount(at[self.fold == f], minlength=len(hashes)) for f in (MAIN, WEIGHING))
            yield kind, hashes, main, weighing


def _edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets of sorted hashes begin and end."""
    at = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(at, np.arange(buckets + 1))


def _packed(counts: np.ndarray) -> bytes:
    """Counts, mostly small, compressed."""
    return pa.compress(counts.astype(np.int64).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), np.int64)


def ask(chunks: DataFrame, buckets: int, order: int = 2) -> DataFrame:
    """What every chunk asks of every bucket, with the counts it adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, hashes, main, weighing in Chunk(row, order).asked():
                    edges = _edges(hashes, buckets)
                    rows = [
                        {
                            "bucket": b,
                            "kind": kind,
                            "chunk": row["chunk"],
                            "hashes": hashes[s:e].tobytes(),
                            "main": _packed(main[s:e]),
                            "weighing": _packed(weighing[s:e]),
                        }
                        for b, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True))
                        if e > s
                    ]
                    yield pa.RecordBatch.from_pylist(rows, _types(ASKED))

    return chunks.mapInArrow(run, ASKED)


def answer(asked: DataFrame) -> DataFrame:
    """The total counts, to each chunk in the order it asked; and how many words training has."""

    def run(rows: pa.Table) -> pa.Table:
        kind, bucket = rows.column("kind")[0].as_py(), rows.column("bucket")[0].as_py()
        parts = rows.column("hashes").to_pylist()
        sizes = [len(p) // 8 for p in parts]
        hashes, back = np.unique(np.frombuffer(b"".join(parts), np.uint64), return_inverse=True)
        total = {}
        for name in ("main", "weighing"):
            counts = np.concatenate([_unpacked(c, n) for c, n in zip(rows.column(name).to_pylist(), sizes, strict=True)])
            total[name] = np.bincount(back, counts, len(hashes)).astype(np.int64)
        ends = np.cumsum(sizes)
        out = []
        for chunk, s, e in zip(rows.column("chunk").to_pylist(), [0, *ends[:-1]], ends, strict=True):
            row = {"chunk": chunk, "kind": kind, "bucket": bucket, "vocabulary": 0}
            for name, counts in total.items():
                row[name] = _packed(counts[back[s:e]])
            out.append(row)
        if kind == WORDS:
            out[0]["vocabulary"] = int(((total["main"] + total["weighing"]) > 0).sum())
        return pa.Table.from_pylist(out, _types(ANSWERS))

    return asked.groupBy("bucket", "kind").applyInArrow(run, ANSWERS)


def _answered(chunk: Chunk, rows: list[dict], buckets: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Total main and weighing counts by kind, in the order of the chunk's hashes."""
    out = {}
    for kind, (hashes, _) in chunk.grams.items():
        edges = _edges(hashes, buckets)
        main, weighing = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for row in rows:
            if row["kind"] == kind:
                s, e = edges[row["bucket"]], edges[row["bucket"] + 1]
                for into, name in ((main, "main"), (weighing, "weighing")):
                    into[s:e] = _unpacked(row[name], int(e - s))
        out[kind] = (main, weighing)
    return out


def _estimates(
    chunk: Chunk, counts: dict[int, np.ndarray], documents: int, tokens: int
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For each token: its word's count, its shares by falling length of n-gram, and its context's bucket."""
    have = {kind: counts[kind][at] for kind, (_, at) in chunk.grams.items()}
    shares, at = [have[WORDS] / max(1, tokens)], np.zeros(len(have[WORDS]), np.int64)
    for length in range(2, len(have) + 1):
        context = np.empty(len(at), np.int64)
        context[1:] = have[length - 1][:-1]
        context[chunk.starts] = documents
        shares.insert(0, have[length] / np.maximum(context, 1))
        at = np.where(context > 0, bucket_of(context) + CONTEXTS * (length - 2), at)
    return have[WORDS], shares, at


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a word never seen, else 1 + the power of two below its count."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def _bin(p: np.ndarray) -> np.ndarray:
    """0 for probability 0, else 1 + quarters of a power of two below 1."""
    with np.errstate(divide="ignore"):
        at = np.floor(-np.log2(p) * BINS_A_BIT)
    return np.where(p > 0, 1 + np.clip(at, 0, LEAST_BIT * BINS_A_BIT), 0).astype(np.int64)


def _middle(at: np.ndarray) -> np.ndarray:
    return np.where(at > 0, 2.0 ** (-(at - 0.5) / BINS_A_BIT), 0.0)


def learn_weights(cells: np.ndarray, uniform: float, rounds: int = 100) -> np.ndarray:
    """Mixture weights (n-grams by falling length, uniform) of each context bucket, by EM on histogram cells.

    ``cells`` has rows (bucket, a bin for the share of each length of n-gram, tokens).
    Buckets without tokens take the weights of the nearest bucket below, or equal ones.
    """
    order = cells.shape[1] - 2
    buckets, mixed = CONTEXTS * max(1, order - 1), order + 1
    weights = np.full((buckets, mixed), 1 / mixed)
    known = np.zeros(buckets, bool)
    for bucket in np.unique(cells[:, 0]) if len(cells) else []:
        own = cells[cells[:, 0] == bucket]
        p = np.column_stack([_middle(own[:, 1:-1]), np.full(len(own), uniform)])
        n, w = own[:, -1], np.full(mixed, 1 / mixed)
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) / n.sum()
        # Unseen words must stay possible however few the held-out tokens.
        weights[bucket] = (w * n.sum() + np.eye(mixed)[-1]) / (n.sum() + 1)
        known[bucket] = True
    for bucket in range(1, buckets):
        if not known[bucket] and known[:bucket].any():
            weights[bucket] = weights[bucket - 1]
    return weights


def bucket_count(partitions: int, tokens: int) -> int:
    """Buckets of the hash space: twice the shuffle partitions, and one for every ``BUCKET_TOKENS`` tokens."""
    return max(16, 2 * partitions, -(-tokens // BUCKET_TOKENS))


def score_documents(docs: DataFrame, order: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    base_score is that of smoothed word counts alone, score that of the mixture, both as sums of
    log10 over the document's tokens. ``order`` is the length of the longest n-grams, 1 or more; each
    further length is one more kind of n-gram to count, stored and shuffled like the bigrams.
    """
    if order < 1:
        raise ValueError(f"order must be 1 or more, not {order}")
    spark = docs.sparkSession
    chunks = stage(tokenise(docs), "chunks")
    sizes = _sizes(chunks)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = bucket_count(partitions, sum(tokens for _, tokens in sizes.values()))
    answers = stage(answer(ask(chunks, buckets, order)), "answers")
    vocabulary = answers.agg(F.sum("vocabulary")).first()[0] or 0
    n_docs, n_tokens = sizes.get(MAIN, (0, 0))
    more_docs, more_tokens = sizes.get(WEIGHING, (0, 0))
    train_docs, train_tokens = n_docs + more_docs, n_tokens + more_tokens
    uniform = 1 / (vocabulary + 1)
    keys = ["b", *(f"p{length}" for length in range(order, 0, -1))]

    def weigh(mine: pa.Table, told: pa.Table) -> pa.Table:
        found = []
        for row in mine.to_pylist():
            chunk = Chunk(row, order)
            counts = {kind: main for kind, (main, _) in _answered(chunk, told.to_pylist(), buckets).items()}
            _, shares, at = _estimates(chunk, counts, n_docs, n_tokens)
            used = chunk.fold == WEIGHING
            cells = np.column_stack([at[used], *(_bin(share[used]) for share in shares)])
            if len(cells):
                kinds, n = np.unique(cells, axis=0, return_counts=True)
                found.append(np.column_stack([kinds, n]))
        rows = np.concatenate(found) if found else np.zeros((0, order + 2), np.int64)
        return pa.table({name: pa.array(rows[:, k], pa.int64()) for k, name in enumerate((*keys, "n"))})

    def score(mine: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in mine.to_pylist():
            chunk = Chunk(row, order)
            counts = {kind: sum(both) for kind, both in _answered(chunk, told.to_pylist(), buckets).items()}
            own, shares, at = _estimates(chunk, counts, train_docs, train_tokens)
            w = weights[at]
            mixed = sum(w[:, k] * share for k, share in enumerate(shares)) + w[:, -1] * uniform
            base = np.log10((own + 0.5) / (train_tokens + 0.5 * (vocabulary + 1)))
            known, scores, bases = (np.add.reduceat(x, chunk.starts) for x in ((own > 0).astype(int), np.log10(mixed), base))
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(chunk.doc_ids, pa.int64()),
                        "held_out": pa.array(chunk.folds == OUTSIDE),
                        "n_tokens": pa.array(chunk.lengths, pa.int64()),
                        "n_known": pa.array(known, pa.int64()),
                        "train_tokens": pa.array(np.full(len(known), train_tokens), pa.int64()),
                        "base_score": pa.array(bases, pa.float64()),
                        "score": pa.array(scores, pa.float64()),
                    }
                )
            )
        return pa.concat_tables(out)

    def matched():
        return chunks.groupBy("chunk").cogroup(answers.drop("vocabulary").groupBy("chunk"))

    cells = stage(matched().applyInArrow(weigh, ", ".join(f"{name} long" for name in (*keys, "n"))), "cells")
    cells = cells.groupBy(*keys).agg(F.sum("n").alias("n")).collect()
    weights = learn_weights(np.array([tuple(c) for c in cells], np.int64).reshape(-1, order + 2), uniform)
    return matched().applyInArrow(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _sizes(chunks: DataFrame) -> dict[int, tuple[int, int]]:
    """Documents and tokens of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folds, lengths in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
                folds, lengths = np.frombuffer(folds, np.uint8), np.frombuffer(lengths, np.uint32)
                for fold in np.unique(folds):
                    own = lengths[folds == fold]
                    yield pa.RecordBatch.from_pydict(
                        {"fold": pa.array([int(fold)], pa.int32()), "docs": [len(own)], "tokens": [int(own.sum())]}
                    )

    rows = chunks.select("folds", "lengths").mapInArrow(run, "fold int, docs long, tokens long")
    return {r.fold: (r.docs, r.tokens) for r in rows.groupBy("fold").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).collect()}
