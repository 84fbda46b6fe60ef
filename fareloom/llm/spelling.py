"""Spelling variants: words one edit from a far more frequent word, grouped under the root of such steps.

Letters are hashed to a few symbols, so a word has a short alphabet's word as its reduced form. The full
neighbourhood of one edit (every deletion, replacement and insertion over the few symbols, and the form
itself) of every reduced form is generated and joined with the reduced forms that occur. Words that are
one edit apart always meet so; those that meet are verified on their original strings. With more
symbols fewer words meet by chance and neighbourhoods grow. By default there are as many symbols as it
takes for a word to share its reduced form with few others on average, which is counted; so a letter
distribution under which most words share one form makes the alphabet larger, not all pairs of them.

Reduced forms are joined by a 64-bit polynomial hash, which a neighbour gets from the hashes of what
stands before and after the edit. A collision brings words together that verification keeps apart.

Every occurrence counts, those in repeated rows too. A null text has no words, a null doc_id counts as
an empty one. Ties between equally frequent near words go to the smaller in code-point order. Tables
without words give empty results. Columns other than doc_id and text are not read. Work on a word
grows with its length, whatever it is; long texts are cut in their task.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import UPPER
from fareloom.llm.shingles import Powers, mix
from fareloom.sources.sinks import drop_staged, stage

# Fixed value: the letters of a word.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
# Keys of reduced forms that are looked up in a broadcast set; more are met by a shuffle.
SET_SIZE = 1 << 21
FEWEST_SYMBOLS, MOST_SYMBOLS = 4, 255
# Words of one reduced form, itself included, that a word has on average at most, if enough symbols are left.
SHARED = 4
# Symbols whose neighbours are made at a time, but for a single longer word.
CHUNK = 100_000


def runs_of(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """doc_id and every run of at least so many letters, in lower case as far as A-Z goes: doc_id, run."""
    # Shorter runs give no word of that length, so the pattern leaves them out.
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    raw = docs.select("doc_id", F.explode(runs).alias("run"))
    run = F.col("run")
    plain = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, UPPER.lower()))
    return raw.select("doc_id", plain.alias("run"))


def misspelt(runs: DataFrame, every: int = 31) -> DataFrame:
    """Runs of which one in ``every``, by the checksum of document and run, loses a letter: word."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.select("run", F.crc32(named).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """The distinct words that are long and frequent enough: word, n."""
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


class Reduced:
    """Reduced forms of several words, laid end to end; symbols count from 1."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, powers: Powers) -> None:
        self.symbols, self.lengths = symbols.astype(np.uint64), lengths
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.word = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(len(symbols)) - self.starts[self.word]
        up, down = powers.upto(int(lengths.max(initial=0)) + 1)
        self.power, self.base, self.inverse = up, up[1], down[1]
        with np.errstate(over="ignore"):
            self.term = self.symbols * up[self.at]
            sums = np.concatenate(([np.uint64(0)], np.cumsum(self.term, dtype=np.uint64)))
            self.before = sums[:-1] - sums[self.starts][self.word]
            self.total = sums[self.ends] - sums[self.starts]

    def keys(self) -> np.ndarray:
        return mix(self.total)

    def neighbours(self, n_symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, key) of all strings at most one edit from each reduced form, each once."""
        word, total = self.word, self.total[self.word]
        yield np.arange(len(self.lengths)), self.keys()
        last = np.full(len(self.symbols), 0, np.uint64)
        last[1:] = np.where(self.at[1:] > 0, self.symbols[:-1], 0)
        with np.errstate(over="ignore"):
            # Letters of a run of equal ones give the same string without them: the first stands for all.
            first = last != self.symbols
            rest = self.before + (total - self.before - self.term) * self.inverse
            yield word[first], mix(rest[first])
            end, end_power = np.arange(len(self.lengths)), self.power[self.lengths]
            final = np.where(self.lengths > 0, self.symbols[np.maximum(self.ends - 1, 0)] if len(self.symbols) else 0, 0)
            for c in map(np.uint64, range(1, n_symbols + 1)):
                other = self.symbols != c
                yield word[other], mix((total + (c - self.symbols) * self.power[self.at])[other])
                # Put before a run of c; after it gives the same string.
                fresh = last != c
                put = self.before + c * self.power[self.at] + (total - self.before) * self.base
                yield word[fresh], mix(put[fresh])
                fresh = final != c
                yield end[fresh], mix((self.total + c * end_power)[fresh])


def _parts(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of rows that have about ``CHUNK`` symbols together."""
    start, size = 0, 0
    for k, n in enumerate(sizes):
        if size and size + n > CHUNK:
            yield slice(start, k)
            start, size = k, 0
        size += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def reduce_words(words: DataFrame, n_symbols: int) -> DataFrame:
    """``words`` (word, n) with reduced (a byte a symbol) and its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            for part in _parts(sizes):
                points = np.frombuffer("".join(texts[part]).encode("utf-32-le"), np.uint32)
                symbols = (points % n_symbols + 1).astype(np.uint8)
                held = Reduced(symbols, sizes[part], powers)
                own = batch.slice(part.start, part.stop - part.start)
                reduced = [symbols[a:b].tobytes() for a, b in zip(held.starts, held.ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(reduced, pa.binary()), pa.array(held.keys().view(np.int64))],
                    names=["word", "n", "reduced", "key"],
                )

    return words.select("word", "n").mapInArrow(run, "word string, n long, reduced binary, key long")


def neighbourhoods(reduced: DataFrame, n_symbols: int) -> DataFrame:
    """Keys of all one-edit neighbours of each of the reduced forms: source (its own key), key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            forms = batch.column(0).to_pylist()
            sizes = np.array([len(f) for f in forms], np.int64)
            for part in _parts(sizes):
                held = Reduced(np.frombuffer(b"".join(forms[part]), np.uint8), sizes[part], powers)
                own = held.keys().view(np.int64)
                for word, keys in held.neighbours(n_symbols):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[word]), pa.array(keys.view(np.int64))], names=["source", "key"]
                    )

    return reduced.select("reduced").mapInArrow(run, "source long, key long")


def coded_words(words: DataFrame, n_symbols: int | None = None) -> tuple[DataFrame, int]:
    """``words`` with their reduced forms, written to the shared folder, and the number of symbols taken."""
    taken = n_symbols or FEWEST_SYMBOLS
    while True:
        coded = stage(reduce_words(words, taken), "reduced")
        if n_symbols or taken == MOST_SYMBOLS:
            return coded, taken
        groups = coded.groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("n"))
        met, held = groups.agg(F.sum(F.col("n") * F.col("n")), F.sum("n")).first()
        if (met or 0) <= SHARED * (held or 0):
            return coded, taken
        drop_staged(coded)
        taken = min(MOST_SYMBOLS, taken + taken // 2)


def near_words(words: DataFrame, n_symbols: int | None = None, set_size: int = SET_SIZE) -> DataFrame:
    """Pairs of ``words`` (word, n) exactly one edit apart, each in both orders: word, near, near_n. Written to the shared folder."""
    coded, n_symbols = coded_words(words, n_symbols)
    keys = coded.select("key").distinct()
    around = neighbourhoods(coded.select("reduced").distinct(), n_symbols)
    few = coded.agg(F.approx_count_distinct("key", 0.02)).first()[0] <= 0.9 * set_size
    met = stage(around.join(F.broadcast(keys) if few else keys.hint("merge"), "key", "left_semi").select("source", "key"), "met")
    left = coded.select(F.col("key").alias("source"), "word")
    right = coded.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = met.join(left, "source").join(right, "key").where((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    # Colliding keys can bring a pair twice.
    found = stage(pairs.select("word", "near", "near_n").distinct(), "near")
    drop_staged(met)
    drop_staged(coded)
    return found


def roots(forms: DataFrame) -> DataFrame:
    """Where following word to form ends: word, root. ``forms`` must not lead in circles.

    Every round doubles the steps taken, and a form is more frequent than its word by a
    factor, so the rounds grow with the logarithm of the logarithm of the largest count.
    """
    steps = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = stage(steps.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        drop_staged(steps)
        steps = further
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, n_symbols: int | None = None, set_size: int = SET_SIZE) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n.

    A word's form is its most frequent near word, if that is at least ``ratio`` (2 or more)
    times as frequent; root is where following forms ends, the word itself without one.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could lead in circles")
    held = stage(words.select("word", "n"), "vocabulary")
    near = near_words(held, n_symbols, set_size)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    joined = held.join(best, "word", "left")
    enough = F.col("near_n") >= ratio * F.col("n")
    told = stage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("near")).alias("form"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    drop_staged(near)
    drop_staged(held)
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
