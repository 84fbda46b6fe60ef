"""Benchmark decontamination: windows of benchmark words found in documents. Native functions only.

Texts are lower-cased in A-Z and cut into words: runs of a-z, 0-9 and anything beyond ASCII. A
window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one
window. Hashes of the distinct windows are broadcast as a set; every window of every document is
looked up there, and those found are compared word by word with the items' windows. A document's
word inside an occurrence of a window is hit; documents with hit words, or the words
themselves, can then be taken out.

The broadcast has a proven bound: at most ``SET_SIZE`` hashes of 8 bytes. Windows beyond it are
dealt to as many sets by hash, and the documents are scanned once for each; the result is the same.

Documents are told apart by a hash of id and text, so rows equal in both get equal results and
count as one. A null or empty text, and one without words, has no words and is never hit. A null
doc_id is an id like any other. An item with a null id hits words, but is neither counted nor
listed; rows of equal item_id are one item with the windows of all its rows. Empty tables give
empty results, or documents without hits. Further columns of the documents are kept by
``remove_hits`` and ``drop_hit``; a name that an operator adds is replaced. Memory is bounded by the longest
single text: windows are made one at a time and only those found are kept.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.llm.common import UPPER, without
from fareloom.sources.sinks import drop_staged, stage

# What separates words, and how many of them a window has.
SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WIDTH = 10
# Hashes in one broadcast set, at most.
SET_SIZE = 1 << 21
HIT_COLUMNS = ("n_words", "n_hit", "n_items", "items", "spans")


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null.

    Separators become spaces and A-Z lower case in one pass, as a pattern over such classes takes several times as long.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def document_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def _cut(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the words of ``text``, which are generated so that no later step cuts them again."""
    return rows.select(*columns, F.explode(F.array(words_of(F.col("text")))).alias("words"))


def _windows(cut: DataFrame, lengths: Iterable[int]) -> DataFrame:
    """``cut`` once for each place where as many words as one of ``lengths`` are left: pos, len, hash."""
    places = cut.where(F.size("words") > 0).select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("pos"))
    places = places.select("*", F.explode(F.array(*map(F.lit, sorted(lengths)))).alias("len"))
    places = places.where(F.col("pos") + F.col("len") <= F.size("words"))
    return places.withColumn("hash", F.xxhash64(F.slice("words", F.col("pos") + 1, F.col("len"))))


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The distinct windows of each item: item_id, window (its words), hash, len."""
    cut = _cut(benchmark.select("item_id", "text"), "item_id").where(F.size("words") > 0)
    length = F.least(F.lit(width), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = cut.select("item_id", "words", length.alias("len"), F.explode(starts).alias("at"))
    windows = windows.select("item_id", F.slice("words", F.col("at"), F.col("len")).alias("window"), "len")
    return windows.withColumn("hash", F.xxhash64("window")).distinct()


def occurrences(docs: DataFrame, windows: DataFrame, set_size: int = SET_SIZE) -> DataFrame:
    """Where windows of ``item_windows`` occur: doc (key), pos, len, window. Written to the shared folder."""
    hashes = windows.select("hash", "len").distinct()
    sizes = {r["len"]: r["n"] for r in hashes.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    sets = max(1, -(-sum(sizes.values()) // set_size))
    keyed = docs.select(document_key("doc_id", "text").alias("doc"), "text")
    cut = _cut(keyed, "doc")
    found = None
    for part in range(sets if sizes else 0):
        own = hashes.where(F.pmod("hash", F.lit(sets)) == part).select("hash").distinct()
        met = _windows(cut, sizes).join(F.broadcast(own), "hash", "left_semi")
        met = met.select("doc", "pos", "len", F.slice("words", F.col("pos") + 1, F.col("len")).alias("window"))
        found = met if found is None else found.union(met)
    if found is None:
        found = cut.select("doc", F.lit(0).alias("pos"), F.lit(0).alias("len"), F.col("words").alias("window")).limit(0)
    met = stage(found, "met")
    # Equal words, not only equal hashes.
    true = met.join(windows.select("window").distinct(), "window", "left_semi").distinct()
    verified = stage(true.select("doc", "pos", "len", "window"), "occurrences")
    drop_staged(met)
    return verified


def hit_spans(found: DataFrame) -> DataFrame:
    """Hit words as maximal spans: doc, start, end (exclusive)."""
    order = W.partitionBy("doc").orderBy("pos", "len")
    before = F.max(F.col("pos") + F.col("len")).over(order.rowsBetween(W.unboundedPreceding, -1))
    places = found.select("doc", "pos", "len").distinct()
    opened = places.withColumn("opens", (F.coalesce(before, F.lit(-1)) < F.col("pos")).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "span").agg(
        F.min("pos").alias("start"), F.max(F.col("pos") + F.col("len")).alias("end")
    ).select("doc", "start", "end")


def _hits(docs: DataFrame, benchmark: DataFrame, width: int, set_size: int) -> DataFrame:
    """Documents with hits: doc, n_hit, n_items, items (ids as sorted strings), spans."""
    windows = stage(item_windows(benchmark, width), "item_windows")
    found = occurrences(docs, windows, set_size)
    spans = hit_spans(found).groupBy("doc").agg(
        F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    # A window that many items share meets each document once.
    named = windows.where("item_id IS NOT NULL").select("window", "item_id")
    pairs = found.select("doc", "window").distinct().join(named, "window").select("doc", "item_id").distinct()
    items = pairs.groupBy("doc").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    hits = spans.join(items, "doc", "left").withColumn("items", F.coalesce("items", none))
    hits = stage(hits.withColumn("n_items", F.size("items").cast("long")), "hits")
    drop_staged(found)
    drop_staged(windows)
    return hits


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, set_size: int = SET_SIZE
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (ids as sorted strings) and spans (start and end of hit words)."""
    hits = _hits(docs.select("doc_id", "text"), benchmark, width, set_size)
    rows = without(docs, HIT_COLUMNS)
    keyed = rows.withColumn("__doc", document_key("doc_id", "text"))
    named = hits.select(F.col("doc").alias("__doc"), "n_hit", "n_items", "items", "spans")
    return keyed.withColumn("n_words", F.size(words_of(F.col("text"))).cast("long")).join(named, "__doc", "left").select(
        *[F.col(f"`{c}`") for c in rows.columns],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def drop_hit(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = 0.0) -> DataFrame:
    """``docs`` without those of which more than ``share`` of the words are hit."""
    marked = decontaminate(docs, benchmark, width)
    return marked.where(F.col("n_hit") <= F.lit(share) * F.col("n_words")).select(*[F.col(f"`{c}`") for c in without(docs, HIT_COLUMNS).columns])


def remove_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the hit words, and what stands between and before them, cut out of ``text``."""
    marked = decontaminate(docs, benchmark, width)
    # A piece is what stands before a word and the word; what follows the last word is one more.
    pieces = F.regexp_extract_all("text", F.lit(rf"{NO_WORD}*{IN_WORD}+|{NO_WORD}+\z"), F.lit(0))
    rest = F.filter(
        pieces,
        lambda piece, k: ~F.exists("spans", lambda span: (k >= span["start"]) & (k < span["end"])),
    )
    columns = without(docs, HIT_COLUMNS).columns
    return marked.select(
        *[
            F.when(F.col("n_hit") > 0, F.array_join(rest, "")).otherwise(F.col("text")).alias("text")
            if c == "text"
            else F.col(f"`{c}`")
            for c in columns
        ]
    )
