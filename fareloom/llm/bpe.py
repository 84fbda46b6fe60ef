"""Byte-level BPE encoding and decoding on length-bucketed, padded numpy matrices.

Texts are cut into pieces by the tokenizer's pattern. The distinct pieces of a batch are laid
out by byte length into matrices, one piece a row. Each round finds every row's leftmost pair
of smallest rank, merges it, and compacts the row by one column; rows without a pair left are
taken out of the matrix. Pairs are looked up in an open-addressing hash table of numpy arrays.

A piece of more than ``LONG_PIECE`` bytes has a matrix of its own, whose rows are stretches of
the piece with their smallest rank kept beside them, so that a round reads only the rows that hold
the smallest rank of all, and rows are compacted when half of them is merged away. As long as no
merge of a rank makes a pair of smaller rank, the next pairs of that rank are the next leftmost
minima, so one round merges them all, up to the first that does. Time is then near to linear in
the piece, not quadratic.

Nulls count as the empty text, which has no ids. Repeated rows are encoded like any other.
Texts and pieces of any length are encoded whole; memory is bounded by one Arrow batch, by the pieces
of ``PART_BYTES`` of its texts (or of one longer text) and by the cache of pieces, which is emptied when it is full.
"""

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import without

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
NO_PAIR = np.int32(2**31 - 1)
CACHED_PIECES = 100_000
# Bytes of text that are cut into pieces at once, and cells of a matrix.
PART_BYTES = 500_000
CELLS = 1 << 18
LONG_PIECE = 1024
STRETCH = 256


class Vocabulary:
    """Ranks of a tokenizer, with its pairs in a hash table of numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.bits = max(4, (4 * max(1, len(pairs))).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_PAIR, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self._fill(keys, values)
        # Tokens that are part of a pair of smaller rank than their own.
        parts = np.concatenate([keys >> 32, keys & 0xFFFFFFFF])
        self.early = set(parts[np.tile(values, 2) < parts].tolist())

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        slots, mask = self._slots(keys), (1 << self.bits) - 1
        while len(keys):
            empty = self.keys[slots] == -1
            self.keys[slots[empty]] = keys[empty]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, ``NO_PAIR`` where the two do not merge or one is padding."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        found = np.full(len(keys), NO_PAIR, np.int32)
        open_rows = np.flatnonzero((left >= 0) & (right >= 0))
        slots, mask = self._slots(keys[open_rows]), (1 << self.bits) - 1
        while len(open_rows):
            held = self.keys[slots]
            hit = held == keys[open_rows]
            found[open_rows[hit]] = self.values[slots[hit]]
            go_on = ~hit & (held != -1)
            open_rows, slots = open_rows[go_on], (slots[go_on] + 1) & mask
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The ranks of a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})


def _merge(vocab: Vocabulary, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge all rows of a matrix padded with -1; yields (row numbers, their final matrix)."""
    rows = np.arange(len(ids))
    ranks = vocab.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    while len(rows):
        at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), int)
        best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NO_PAIR)
        done = best == NO_PAIR
        if done.any():
            yield rows[done], ids[done]
            rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
            if not len(rows):
                return
        n, line = len(rows), np.arange(len(rows))
        columns = np.arange(ids.shape[1] - 1)[None, :]
        ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
        ids[line, at] = best
        columns = columns[:, : ranks.shape[1] - 1]
        ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
        width = ids.shape[1]
        for side in (at - 1, at):
            ok = np.flatnonzero((side >= 0) & (side < width - 1))
            ranks[ok, side[ok]] = vocab.pair_ranks(ids[ok, side[ok]], ids[ok, side[ok] + 1])
        # Rows are as wide as the longest one left; drop columns that are padding in all rows.
        used = int((ids >= 0).sum(axis=1).max()) if n else 0
        if used < width:
            ids, ranks = ids[:, :used], ranks[:, : max(0, used - 1)]


class _LongPiece:
    """One long piece: ids in stretches, and for each place the rank of its pair with the next one.

    Merged places hold -1 and ``NO_PAIR``. ``before`` and ``after`` lead over them.
    """

    def __init__(self, vocab: Vocabulary, ids: np.ndarray):
        self.vocab = vocab
        rows = -(-len(ids) // STRETCH)
        self.ids = np.full(rows * STRETCH, -1, np.int32)
        self.ids[: len(ids)] = ids
        places = np.arange(len(self.ids))
        self.before, self.after = places - 1, np.minimum(places + 1, len(places) - 1)
        self.ranks = np.full(len(places), NO_PAIR, np.int32)
        self.ranks[:-1] = vocab.pair_ranks(self.ids[:-1], self.ids[1:])
        self.table = self.ranks.reshape(rows, STRETCH)
        self.least = self.table.min(axis=1)

    def lowest(self) -> tuple[int, np.ndarray]:
        """The smallest rank of all and the places that hold it, from left to right."""
        rank = int(self.least.min())
        rows = np.flatnonzero(self.least == rank) if rank != NO_PAIR else np.zeros(0, np.int64)
        row, column = np.nonzero(self.table[rows] == rank)
        return rank, rows[row] * STRETCH + column

    def before_smaller(self, rank: int, at: np.ndarray) -> np.ndarray:
        """``at`` up to the first place whose merge, after those before it, makes a pair of smaller rank."""
        left, gone = self.before[at], self.after[at]
        right = self.after[gone]
        token = np.full(len(at), rank, np.int32)
        ahead = np.where(left >= 0, self.ids[left], -1)
        ahead[1:][left[1:] == gone[:-1]] = rank
        behind = np.where(right == gone, -1, self.ids[right])
        made = np.minimum(self.vocab.pair_ranks(ahead, token), self.vocab.pair_ranks(token, behind))
        smaller = np.flatnonzero(made < rank)
        return at[: smaller[0] + 1] if len(smaller) else at

    def merge(self, rank: int, at: np.ndarray) -> None:
        """Merge the pairs at places that do not overlap, and rank the pairs they are now part of."""
        gone = self.after[at]
        beyond = self.after[gone]
        self.ids[at], self.ids[gone], self.ranks[gone] = rank, -1, NO_PAIR
        # The last place leads to itself, and a merged last one to nothing.
        ends = beyond == gone
        self.after[at] = np.where(ends, at, beyond)
        self.before[beyond[~ends]] = at[~ends]
        changed = np.concatenate([self.before[at], at])
        changed = changed[changed >= 0]
        following = self.after[changed]
        ranks = self.vocab.pair_ranks(self.ids[changed], self.ids[following])
        self.ranks[changed] = np.where(following == changed, NO_PAIR, ranks)
        rows = np.unique(np.concatenate([changed, gone]) // STRETCH)
        self.least[rows] = self.table[rows].min(axis=1)


def _merge_long(vocab: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Final ids of one long piece, always by its leftmost pairs of smallest rank."""
    piece, left = _LongPiece(vocab, ids), len(ids)
    while True:
        rank, at = piece.lowest()
        if not len(at):
            return piece.ids[piece.ids >= 0]
        if len(at) > 1:
            # In a run of overlapping pairs every other one is merged, from the left.
            line = np.arange(len(at))
            follows = np.concatenate([[False], piece.after[at[:-1]] == at[1:]])
            at = at[(line - np.maximum.accumulate(np.where(follows, 0, line))) % 2 == 0]
            if rank in vocab.early:
                at = piece.before_smaller(rank, at)
        piece.merge(rank, at)
        left -= len(at)
        if left < len(piece.ids) // 2 and left > STRETCH:
            piece = _LongPiece(vocab, piece.ids[piece.ids >= 0])


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(pieces)
    buckets: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        rank = vocab.ranks.get(piece)
        if rank is not None:
            out[k] = rank.to_bytes(4, "little")
        elif piece:
            # Narrow buckets for the usual short pieces, powers of two beyond.
            n = len(piece)
            if n > LONG_PIECE:
                own = vocab.byte_ids[np.frombuffer(piece, np.uint8)]
                out[k] = _merge_long(vocab, own).astype("<u4").tobytes()
                continue
            buckets.setdefault(n if n <= 24 else 1 << (n - 1).bit_length(), []).append(k)
    for width, members in buckets.items():
        step = max(1, CELLS // width)
        for start in range(0, len(members), step):
            part = members[start : start + step]
            sizes = np.array([len(pieces[k]) for k in part])
            ids = np.full((len(part), int(sizes.max())), -1, np.int32)
            flat = np.frombuffer(b"".join(pieces[k] for k in part), np.uint8)
            ids[np.arange(ids.shape[1])[None, :] < sizes[:, None]] = vocab.byte_ids[flat]
            for rows, merged in _merge(vocab, ids):
                kept = merged >= 0
                data, ends = merged[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(axis=1)) * 4
                begin = 0
                for row, end in zip(rows.tolist(), ends.tolist(), strict=True):
                    out[part[row]] = data[begin:end]
                    begin = end
    return out


def encode_texts(vocab: Vocabulary, texts: Iterable[str | None], pattern: regex.Pattern, cache: dict) -> list[bytes]:
    """Ids of each text. ``cache`` holds pieces met before and is emptied when full."""
    cut = [pattern.findall(text) if text else [] for text in texts]
    if len(cache) > CACHED_PIECES:
        cache.clear()
    fresh = list(set().union(*cut) - cache.keys())
    cache.update(zip(fresh, encode_pieces(vocab, [p.encode() for p in fresh]), strict=True))
    return [b"".join(map(cache.__getitem__, pieces)) for pieces in cut]


def decode_ids(vocab: Vocabulary, ids: bytes) -> bytes:
    """Bytes of little-endian unsigned 32-bit ids. An id outside the vocabulary raises KeyError."""
    return b"".join(map(vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, whose last column is the text, of so many bytes of text or one longer text."""
    start, size = 0, 0
    for k, more in enumerate(pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()):
        more = more or 0
        if k > start and size + more > PART_BYTES:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += more
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(
    df: DataFrame,
    text: str = "text",
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    digests: bool = False,
    decoded_digest: bool = False,
) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` bytes.

    ``decoded`` is what the ids decode to. With ``digests`` the two binaries are returned as
    ``ids_sha256`` and ``decoded_sha256`` instead, and never leave the Python worker; the text
    is not carried along. With ``decoded_digest`` that holds for the decoded bytes alone. Columns
    of these names in the input are replaced.
    """
    path = ranks_path or public_tokenizers.path(RANKS_FILE)
    hashed = {"ids": digests, "decoded": digests or decoded_digest}
    added = ["n_tokens", *(f"{name}_sha256" if short else name for name, short in hashed.items())]
    kept = without(df.drop(text) if digests or decoded_digest else df, added)
    source = [F.col(f"`{c}`") for c in kept.columns]
    rows = df.select(*source, F.col(f"`{text}`").alias("__text"))
    schema = df.select(*source).schema
    kinds = ["string" if short else "binary" for short in hashed.values()]
    for name, kind in zip(added, ("long", *kinds), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, cut, cache = vocabulary(path), regex.compile(pattern), {}
        for batch in batches:
            for part in _parts(batch):
                ids = encode_texts(vocab, part.column(part.num_columns - 1).to_pylist(), cut, cache)
                decoded = [decode_ids(vocab, i) for i in ids]
                columns = part.columns[:-1]
                columns.append(pa.array([len(i) // 4 for i in ids], pa.int64()))
                for values, short in zip((ids, decoded), hashed.values(), strict=True):
                    if short:
                        columns.append(pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string()))
                    else:
                        columns.append(pa.array(values, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
