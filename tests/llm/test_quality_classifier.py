"""The positive-unlabelled quality classifier: held-out accuracy, class prior, odd rows."""

import zlib

import numpy as np
import pytest

from fareloom.llm import quality
from fareloom.llm.queries import op5_quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_classes_are_learned_without_negatives(prior):
    rng = np.random.default_rng(1)

    def draw(n, good):
        return rng.normal(np.where(good, 1.5, -1.5)[:, None], 1.0, (n, 3))

    positive = draw(3000, np.ones(3000, bool))
    good = rng.random(4000) < prior
    model = quality.fit(positive, draw(4000, good))
    assert abs(model.prior - prior) < 0.08
    good = rng.random(3000) < prior
    assert ((model.scores(draw(3000, good)) >= 0.5) == good).mean() > 0.95


def test_features_of_odd_texts():
    for text in (None, "", " ", "\n", "a", "É", "!!!", "x" * 200_000, "\u0000", "🙂 " * 9):
        found = quality.features(text)
        assert found.shape == quality.features("abc def").shape and np.isfinite(found).all()


def test_held_out_accuracy_of_the_query(spark):
    rows = {r.doc_id: r for r in op5_quality(spark, SF_DIR).collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if rows[r.doc_id].held_out]
    good, bad = ([rows[r.doc_id].score for r in held if r.quality == q] for q in (1, 0))
    assert (np.array(good)[:, None] > np.array(bad)).mean() > 0.98
    assert (np.array(good) >= 0.3).mean() > 0.97 and (np.array(bad) >= 0.3).mean() < 0.1


def test_only_the_fold_and_positives_are_trusted(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('t ', id) AS text")
    labels = spark.range(300).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    trusted = sum(i % 2 and zlib.crc32(str(i).encode()) % 5 != 0 for i in range(300))
    positive, unlabelled = quality.sample(docs.union(docs), labels, 1000)
    assert (len(positive), len(unlabelled)) == (trusted, 300)
    positive, unlabelled = quality.sample(docs, labels, 20)
    assert (len(positive), len(unlabelled)) == (20, 20)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (3, "a b", 2), (3, "a b", 2)], "doc_id long, text string, Predicted int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(df, none) is None
    out = quality.score(df, None)
    assert out.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    assert [(r.score, r.predicted) for r in out.collect()] == [(0.5, 1)] * 3
    some = spark.createDataFrame([(3, 1, 0), (3, None, 0), (None, 1, 0)], none.schema)
    model = quality.train(df, some)
    assert [0 <= r.score <= 1 for r in quality.score(df, model).collect()] == [True] * 3
    assert quality.score(df.limit(0), model).count() == 0
