"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's score is logistic in its words; a document's score is the noisy-or of its
sentences' scores. Only documents carry labels: the gradient of their log-likelihood reaches a
sentence in proportion to how much it could have caused the label, so sentences that offend are
found without a label of their own.

The model is fitted on a sample of labelled documents, bounded in documents and in words (the
first in the order of a hash of the id, without those longer than a twentieth of the sample); it
is the only thing the driver holds. Every document is scored as a whole, sentence by sentence, in
bounded memory.

Null and empty texts have no sentences and score 0. Without both labels in the sample every
score is 0 or that of a constant model. Repeated rows are scored like any other, a null id is
never held out and never learned from. Empty tables give empty results; further columns are
kept, and those named like an added one replaced.
"""

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from fareloom.llm.common import in_fold, labelled, without

HELD_OUT = 0
SENTENCE_END = re.compile(r"[.!?\n]+")
EDGES = "\"'`,;:()[]{}<>|*_#$%&@+=~^/\\-"

# The largest sample the model is fitted on.
MOST_DOCUMENTS = 8_000
MOST_WORDS = 3_000_000
CACHED_WORDS = 100_000
# A document longer than one such part of the sample's characters is not in the sample.
LONGEST_PART = 20


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence, lower-cased and without punctuation at their ends."""
    out = []
    for part in SENTENCE_END.split((text or "").lower()):
        words = [w for w in (x.strip(EDGES) for x in part.split()) if w]
        if words:
            out.append(words)
    return out


def word_features(word: str) -> list[str]:
    """The word and its beginnings and ends: insults inflect, and languages join words."""
    return [word, *(f"^{word[:n]}" for n in (3, 4, 5) if len(word) > n), *(f"{word[-n:]}$" for n in (3, 4) if len(word) > n)]


class Model:
    """Feature weights and the bias of a sentence without known features."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._words: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def _word(self, word: str) -> float:
        if len(self._words) >= CACHED_WORDS:
            self._words.clear()
        weight = self._words[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return weight

    def sentence_scores(self, text: str | None) -> np.ndarray:
        known, new = self._words.get, self._word
        sums = []
        for words in sentences(text):
            total = 0.0
            for word in set(words):
                weight = known(word)
                total += new(word) if weight is None else weight
            sums.append(total)
        return 1 / (1 + np.exp(-np.clip(np.array(sums, float) + self.bias, -40, 40)))

    def score(self, text: str | None) -> float:
        """Noisy-or of the sentence scores: 1 - product of (1 - score)."""
        p = self.sentence_scores(text)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def choose_features(found: Iterable[set[str]], y: np.ndarray, most: int) -> dict[str, int]:
    """The features of at least three documents (sets of words) that are most associated with the label (chi-square)."""
    having, toxic = Counter(), Counter()
    for doc, label in zip(found, y, strict=True):
        features = {f for w in doc for f in word_features(w)}
        having.update(features)
        if label:
            toxic.update(features)
    names = [f for f, n in having.items() if n >= 3]
    n = np.array([having[f] for f in names], float)
    k = np.array([toxic[f] for f in names], float)
    rate = y.mean()
    chi = (k - n * rate) ** 2 / np.maximum(n * rate * (1 - rate) * (1 - n / len(y) * 0.999), 1e-9)
    best = sorted(range(len(names)), key=lambda i: (-chi[i], names[i]))[:most]
    return {names[i]: j for j, i in enumerate(best)}


def fit(
    texts: list[str | None],
    labels: list[int],
    most_features: int = 400,
    steps: int = 300,
    rate: float = 0.1,
    penalty: float = 1e-3,
) -> Model:
    """Maximise the noisy-or likelihood of document labels by Adam, with an L1 penalty on weights."""
    # Words are held as numbers, all sentences in one array: the sample has millions of words but far fewer different ones.
    number: dict[str, int] = {}
    words, ends, sizes, kept = array("i"), array("q", [0]), [], []
    for k, text in enumerate(texts):
        found = sentences(text)
        for sentence in found:
            words.extend([number.setdefault(w, len(number)) for w in sentence])
            ends.append(len(words))
        if found:
            kept.append(k)
            sizes.append(len(found))
    y = np.array([labels[k] for k in kept], float)
    if not 0 < y.sum() < len(kept):
        return Model({}, 0.0 if y.sum() else -40.0)
    names = list(number)
    last = np.cumsum(sizes)
    spans = zip((last - sizes).tolist(), last.tolist(), strict=True)
    features = choose_features(({names[w] for w in words[ends[i] : ends[j]]} for i, j in spans), y, most_features)
    ids = [[features[f] for f in word_features(name) if f in features] for name in names]
    document = np.repeat(np.arange(len(kept)), sizes)
    sentence, feature = array("q"), array("q")
    for s in range(len(document)):
        for word in set(words[ends[s] : ends[s + 1]]):
            known = ids[word]
            if known:
                sentence.extend([s] * len(known))
                feature.extend(known)
    del words, ends, number, names, ids
    sentence, feature = np.frombuffer(sentence, np.int64), np.frombuffer(feature, np.int64)
    n, size = len(kept), len(features)
    theta = np.zeros(size + 1)
    theta[-1] = -4 - np.log(max(1.0, len(document) / n))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, theta[feature], len(document)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        silent = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), n)
        clean = np.exp(np.minimum(silent, -1e-9))
        # d log P(label) / dz of a sentence: p * clean / (1 - clean) if toxic, -p if not.
        pull = np.where(y > 0, clean / (1 - clean), -1.0)[document] * p / n
        grad = np.append(np.bincount(feature, pull[sentence], size), pull.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        # Proximal step of the L1 penalty, not for the bias.
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - rate * penalty, 0)
    return Model({f: float(theta[k]) for f, k in features.items() if theta[k]}, float(theta[-1]))


def sample(docs: DataFrame, labels: DataFrame, label: str, most_documents: int, most_words: int) -> tuple[list, list]:
    """Texts and labels of at most so many labelled documents and words, in the order of a hash."""
    # So few ids that a broadcast is bounded whatever the tables' size; no text is shuffled to find them.
    at = F.xxhash64("doc_id")
    ids = F.broadcast(labelled(labels, label, HELD_OUT).orderBy(at, "doc_id").limit(most_documents))
    size, most_chars = F.coalesce(F.length("text"), F.lit(0)), 6 * most_words
    # Only ids and lengths pass through the one task that adds them up; of repeated ids the shortest text counts.
    key = F.xxhash64("text")
    found = docs.select("doc_id", size.alias("size"), key.alias("key")).join(ids, "doc_id")
    least = found.groupBy("doc_id").agg(F.min(F.struct("size", "key")).alias("text"))
    sizes = least.select("doc_id", "text.size", "text.key").where(F.col("size") * LONGEST_PART <= most_chars)
    until = F.sum("size").over(W.orderBy(at, "doc_id").rowsBetween(W.unboundedPreceding, 0))
    chosen = sizes.withColumn("chars", until).where(F.col("chars") <= most_chars).select("doc_id", "size", "key")
    chosen = F.broadcast(chosen.join(ids, "doc_id"))
    texts = docs.select("doc_id", "text", size.alias("size"), key.alias("key"))
    rows = texts.join(chosen, ["doc_id", "size", "key"]).dropDuplicates(["doc_id"]).select("text", "label").collect()
    return [r.text for r in rows], [r.label for r in rows]


def train(
    docs: DataFrame, labels: DataFrame, most_documents: int = MOST_DOCUMENTS, most_words: int = MOST_WORDS
) -> Model:
    """A model fitted on labelled documents outside the held-out fold."""
    return fit(*sample(docs, labels, "toxic", most_documents, most_words))


def score(docs: DataFrame, model: Model, spans: bool = False, threshold: float = 0.5) -> DataFrame:
    """``docs`` with held_out, score and predicted; with ``spans`` the offending sentences too.

    ``offending`` holds the numbers (from 0) of the sentences whose own score reaches 0.5.
    """
    added = ["held_out", "score", "predicted", *(["offending"] if spans else [])]
    source = [F.col(f"`{c}`") for c in without(docs, added).columns]
    rows = docs.select(*source, in_fold(F.col("doc_id"), HELD_OUT).alias("held_out"), F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer")
    if spans:
        schema = schema.add("offending", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            scores = [model.score(t.as_py()) for t in texts]
            columns = [*batch.columns[:-1], pa.array(scores, pa.float64())]
            columns.append(pa.array([int(s >= threshold) for s in scores], pa.int32()))
            if spans:
                found = [np.flatnonzero(model.sentence_scores(t.as_py()) >= 0.5) for t in texts]
                columns.append(pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
