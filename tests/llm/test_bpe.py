"""BPE against the tiktoken library."""

import hashlib
import heapq
import random
import struct
import time
import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fareloom.llm import bpe
from fareloom.llm.queries import op2_bpe

SF_DIR = "/root/testdata/sf0.001"
PATH = P.path(bpe.RANKS_FILE)
VOCAB = bpe.vocabulary(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=VOCAB.ranks, special_tokens={})
CUT = regex.compile(P.PATTERN)

TEXTS = [
    "", None, " ", "a", "Hello world", "it's  fine\n\n\tok", "naïve café – 东京 🙂", "a" * 5000, "ab" * 999 + " x",
    "<|endoftext|>", "1234567890" * 50, "\u0000\u0001", "thhentinly ouhaes" * 40,
]


def ids_of(text):
    return struct.pack(f"<{len(x)}I", *x) if (x := LIBRARY.encode_ordinary(text or "")) else b""


def test_ids_equal_the_librarys_and_decode_to_the_text():
    for text, ids in zip(TEXTS, bpe.encode_texts(VOCAB, TEXTS, CUT, {}), strict=True):
        assert ids == ids_of(text)
        assert bpe.decode_ids(VOCAB, ids) == (text or "").encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(texts):
    assert bpe.encode_texts(VOCAB, texts, CUT, {}) == [ids_of(t) for t in texts]


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    cache = {}
    for _ in range(3):
        assert bpe.encode_texts(VOCAB, TEXTS, CUT, cache) == [ids_of(t) for t in TEXTS]


def test_memory_of_a_worker_is_bounded_by_a_part_of_a_batch():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöü", k=rng.randint(4, 9)))
    texts = [" ".join(word() for _ in range(300)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    cache, ids = {}, []
    tracemalloc.start()
    for part in bpe._parts(batch):
        ids += bpe.encode_texts(VOCAB, part.column(1).to_pylist(), CUT, cache)
    peak = tracemalloc.get_traced_memory()[1] - sum(map(len, ids))
    tracemalloc.stop()
    assert peak < 75e6
    assert ids[::100] == [ids_of(t) for t in texts[::100]]


def test_parts_of_a_batch_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 10)
    texts = ["", None, "x" * 25, "abc", "défg", "hi", None, "y" * 11, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(bpe._parts(batch))
    assert [t for part in parts for t in part.column(1).to_pylist()] == texts
    assert [k for part in parts for k in part.column(0).to_pylist()] == list(range(len(texts)))
    assert [part.num_rows for part in parts] == [2, 1, 4, 1, 1]
    assert list(bpe._parts(batch.slice(0, 0))) == []


def merged_by_heap(piece):
    """Ids of a piece, by a heap of (rank, place) over a linked list."""
    parts, after, before = [piece[i : i + 1] for i in range(len(piece))], list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    heap = []

    def push(i):
        if 0 <= i and after[i] < len(piece):
            rank = VOCAB.ranks.get(parts[i] + parts[after[i]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

    for i in range(len(piece)):
        push(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= len(piece) or parts[j] != right:
            continue
        parts[i], parts[j], after[i] = left + right, None, after[j]
        if after[j] < len(piece):
            before[after[j]] = i
        push(before[i])
        push(i)
    return b"".join(struct.pack("<I", VOCAB.ranks[p]) for p in parts if p is not None)


LONG_ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "the", "äöüßabcXYZ东京", "ABCDEFGHabcdefgh0123456789+/"]


@pytest.mark.parametrize("alphabet", LONG_ALPHABETS)
@pytest.mark.parametrize("length", [bpe.LONG_PIECE, bpe.LONG_PIECE + 1, 3000, 20_000])
def test_long_pieces_equal_the_librarys(alphabet, length):
    draw = random.Random(length)
    text = "".join(draw.choice(alphabet) for _ in range(length))
    assert bpe.encode_texts(VOCAB, [text, text + " end"], CUT, {}) == [ids_of(text), ids_of(text + " end")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", "ing", "tion", "zz", "ß", "aaa", "tthh", "ab"]), min_size=3, max_size=300))
def test_the_long_form_equals_the_librarys_at_any_length(parts):
    piece = "".join(parts).encode()
    own = bpe._merge_long(VOCAB, VOCAB.byte_ids[np.frombuffer(piece, np.uint8)])
    assert own.astype("<u4").tobytes() == merged_by_heap(piece)
    if piece not in VOCAB.ranks:
        assert own.tolist() == LIBRARY._core_bpe.encode_single_piece(piece)


def test_a_million_letters_in_seconds():
    draw = random.Random(3)
    piece = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)).encode()
    start = time.monotonic()
    ids = bpe.encode_pieces(VOCAB, [piece])[0]
    # About 3 seconds on one core; a round for every merge would take hours.
    assert time.monotonic() - start < 60
    assert ids == merged_by_heap(piece) and bpe.decode_ids(VOCAB, ids) == piece


def test_unknown_id():
    with pytest.raises(KeyError):
        bpe.decode_ids(VOCAB, struct.pack("<I", 50_256))


def test_operator_keeps_columns_and_replaces_clashing_names(spark):
    big = 2**62 + 1
    df = spark.createDataFrame(
        [(None, None, 1), (big, "Hello world", 2), (big, "Hello world", 2)], "doc_id long, text string, IDS int"
    )
    rows = bpe.encode(df).collect()
    assert [r.doc_id for r in rows] == [None, big, big] and bpe.encode(df).columns == [
        "doc_id", "text", "n_tokens", "ids", "decoded",
    ]
    assert bytes(rows[0].ids) == b"" and rows[0].n_tokens == 0
    assert bytes(rows[1].ids) == ids_of("Hello world") and bytes(rows[1].decoded) == b"Hello world"
    assert bpe.encode(df.limit(0)).count() == 0


def test_query_over_all_documents(spark):
    rows = op2_bpe(spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
