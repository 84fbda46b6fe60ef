"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled good; everything else, labelled bad or not at all, is
unlabelled web text. The risk of a classifier on the unseen negatives is what its risk on
unlabelled text exceeds the share of positives by; that difference is kept from going below
zero, where a flexible classifier would otherwise overfit. The share of positives, the class
prior, is estimated from the two samples: the smallest ratio of unlabelled to positive mass
above any threshold of a first classifier.

Features are shares and ratios of the whole text, computed where the text is; the driver holds
the features of two samples of bounded size (the first documents in the order of a hash of the
id). A null text counts as empty; empty texts have a score like any other. Without positives or
unlabelled texts every score is 0.5. Repeated rows are scored like any other; a null id is never
held out and never learned from. Empty tables give empty results; further columns are kept, and
those named like an added one replaced.
"""

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import in_fold, labelled, without

HELD_OUT = 0
# The largest sample of each kind that the model is fitted on.
MOST_DOCUMENTS = 8_000
THRESHOLD = 0.3

_KIND = np.full(256, 6)  # symbols
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_KIND[128:] = 4
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 5
_KINDS = 7


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of bytes, word and line statistics of a whole text."""
    text = text or ""
    kinds = np.bincount(_KIND[np.frombuffer(text.encode(), np.uint8)], minlength=_KINDS) / max(1, len(text))
    words = text.split()
    n = len(words)
    lines = [line for line in text.split("\n") if line]
    lowered = set(map(str.lower, words))
    repeated = sum(map(eq, words, words[1:])) / max(1, n - 1)
    letters = sum(map(len, words)) / max(1, n)
    upper = kinds[1] / max(1e-9, kinds[0] + kinds[1] + kinds[4]) if n else 0.0
    return np.array(
        [
            *kinds,
            upper,
            np.log1p(n),
            letters / 10,
            len(lowered) / max(1, n) if n else 0.0,
            repeated,
            text.count("|") / max(1, n),
            text.count("!") / max(1, n),
            len(set(lines)) / max(1, len(lines)),
            sum(kinds[5:]) * len(text) / max(1, n),
        ]
    )


class Model:
    """Logistic in the standardised features and their squares, clipped at the ends."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.hstack([z, z**2 - 1, np.ones((len(z), 1))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -30, 30)))


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        grad = gradient(theta)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least_mass: float = 0.5) -> float:
    """The smallest share of unlabelled over share of positive scores above any threshold.

    Only thresholds that ``least_mass`` of the positives pass count, where the shares are steady.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - least_mass, 101))
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    return float(np.clip((above_u / above_p).min(), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, rate: float = 0.03, penalty: float = 1e-3) -> Model:
    """Minimise the non-negative risk: prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))."""
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    model = Model(mean, scale, np.zeros(0), 0.5)
    p, u = model.design(positive), model.design(unlabelled)

    def first_gradient(theta: np.ndarray) -> np.ndarray:
        return p.T @ (_sigmoid(p @ theta) - 1) / len(p) + u.T @ _sigmoid(u @ theta) / len(u) + penalty * theta

    first = _descend(first_gradient, p.shape[1], steps // 2, rate)
    prior = estimate_prior(p @ first, u @ first)

    def gradient(theta: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(p @ theta), _sigmoid(u @ theta)
        # Logistic losses: log(1 + e^-z) of a positive, log(1 + e^z) of a negative.
        negative = np.logaddexp(0, u @ theta).mean() - prior * np.logaddexp(0, p @ theta).mean()
        of_positives = prior * (p.T @ (sp - 1)) / len(p)
        of_negatives = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative < 0:  # step back until the negative risk is possible again
            return -of_negatives
        return of_positives + of_negatives + penalty * theta

    return Model(mean, scale, _descend(gradient, p.shape[1], steps, rate), prior)


def sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of at most ``most`` trusted positives and ``most`` documents of any kind."""
    at = F.xxhash64("doc_id")
    trusted = labelled(labels, "quality", HELD_OUT).where("label = 1").select("doc_id")
    any_kind = docs.where("doc_id IS NOT NULL").select("doc_id").distinct()
    # At most 2 * most rows, so the broadcast is bounded whatever the tables' size.
    ids = (
        trusted.orderBy(at, "doc_id").limit(most).withColumn("trusted", F.lit(True))
        .union(any_kind.orderBy(at, "doc_id").limit(most).withColumn("trusted", F.lit(False)))
    )
    rows = _with_features(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"))
    # A repeated document counts once.
    got = rows.groupBy("doc_id", "trusted").agg(F.min("features").alias("features")).select("trusted", "features").collect()
    parts = [[r.features for r in got if r.trusted is kind] for kind in (True, False)]
    return tuple(np.array(part, float) for part in parts)


def _with_features(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("trusted"), pa.array(found, pa.list_(pa.float64()))],
                names=["doc_id", "trusted", "features"],
            )

    return rows.select("doc_id", "trusted", "text").mapInArrow(run, "doc_id long, trusted boolean, features array<double>")


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_DOCUMENTS) -> Model | None:
    """A model from trusted positives outside the held-out fold and unlabelled documents."""
    positive, unlabelled = sample(docs, labels, most)
    return fit(positive, unlabelled) if len(positive) and len(unlabelled) else None


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    source = [F.col(f"`{c}`") for c in without(docs, ["held_out", "score", "predicted"]).columns]
    rows = docs.select(*source, in_fold(F.col("doc_id"), HELD_OUT).alias("held_out"), F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            if model is None:
                scores = np.full(len(texts), 0.5)
            elif len(texts):
                scores = model.scores(np.array([features(t.as_py()) for t in texts]))
            else:
                scores = np.zeros(0)
            columns = [*batch.columns[:-1], pa.array(scores, pa.float64())]
            columns.append(pa.array((scores >= threshold).astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
