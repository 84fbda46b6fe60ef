"""Toxicity: held-out accuracy, located sentences, odd rows."""

import random
import tracemalloc
import zlib

import numpy as np

from fareloom.llm import toxicity
from fareloom.llm.queries import op4_toxicity

SF_DIR = "/root/testdata/sf0.01"


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    above = (scores[labels == 1][:, None] > scores[labels == 0]).mean()
    return above + 0.5 * (scores[labels == 1][:, None] == scores[labels == 0]).mean()


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    texts, labels, at = [], [], []
    for _ in range(n):
        doc = [" ".join(rng.choices(words, k=rng.randint(3, 9))) for _ in range(rng.randint(1, 30))]
        bad = rng.random() < 0.3
        where = rng.randrange(len(doc))
        if bad:
            doc[where] += f" vileword{rng.choice(['', 's', 'ish'])}"
        texts.append(". ".join(doc) + ".")
        labels.append(int(bad))
        at.append(where if bad else None)
    return texts, labels, at


def test_sentences_are_located_from_document_labels():
    texts, labels, _ = corpus(600, 1)
    model = toxicity.fit(texts, labels)
    texts, labels, at = corpus(300, 2)
    scores = [model.score(t) for t in texts]
    assert auc(scores, labels) > 0.99
    for text, where in zip(texts, at, strict=True):
        found = np.flatnonzero(model.sentence_scores(text) >= 0.5).tolist()
        assert found == ([] if where is None else [where])


def test_fitting_holds_equal_words_once():
    texts, labels, _ = corpus(600, 3)
    words = sum(len(t.split()) for t in texts)
    tracemalloc.start()
    toxicity.fit(texts, labels, steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 110 * words


def test_fitting_holds_words_as_numbers():
    texts, labels, _ = corpus(3000, 3)
    words = sum(len(t.split()) for t in texts)
    tracemalloc.start()
    toxicity.fit(texts, labels, steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70 * words


def test_noisy_or_of_sentences():
    model = toxicity.Model({"bad": 2.0}, -1.0)
    p = model.sentence_scores("bad thing. fine\nBAD!")
    assert len(p) == 3 and p[0] == p[2] > p[1]
    assert abs(model.score("bad thing. fine\nBAD!") - (1 - np.prod(1 - p))) < 1e-12
    assert model.score(None) == model.score("") == model.score(" .!? ") == 0
    assert 0 <= model.score("bad. " * 50_000) <= 1


def test_samples_without_both_labels():
    assert toxicity.fit([], []).score("x") < 1e-9
    assert toxicity.fit(["a b", "c"], [0, 0]).score("a") < 1e-9
    assert 0 <= toxicity.fit(["a b", None], [1, 1]).score("a") <= 1


def test_held_out_accuracy_of_the_query(spark):
    rows = {r.doc_id: r for r in op4_toxicity(spark, SF_DIR).collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert auc([rows[r.doc_id].score for r in held], [r.toxic for r in held]) > 0.95


def test_odd_rows(spark):
    model = toxicity.Model({"bad": 9.0}, -5.0)
    df = spark.createDataFrame([(None, None, 1), (3, "bad. ok", 2), (3, "bad. ok", 2)], "doc_id long, text string, Score int")
    out = toxicity.score(df, model, spans=True)
    assert out.columns == ["doc_id", "text", "held_out", "score", "predicted", "offending"]
    rows = sorted(out.collect(), key=str)
    assert [(r.predicted, r.offending) for r in rows] == [(1, [0]), (1, [0]), (0, [])] and rows[2].held_out is False
    assert toxicity.score(df.limit(0), model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(df, empty).score("bad") < 1e-9


def test_the_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('t ', id) AS text")
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    texts, marks = toxicity.sample(docs, labels, "toxic", 50, 10**6)
    assert len(texts) == 50 and all(int(t[2:]) % 2 == y for t, y in zip(texts, marks, strict=True))
    assert all(zlib.crc32(t[2:].encode()) % 5 for t in texts)
    assert len(toxicity.sample(docs, labels, "toxic", 50, 10)[0]) < 50


def test_long_documents_do_not_end_the_sample(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "CASE WHEN id % 10 = 0 THEN repeat('long ', 2000) ELSE concat('t ', id) END AS text")
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    texts, _ = toxicity.sample(docs.union(docs), labels, "toxic", 200, 1000)
    want = [f"t {i}" for i in range(200) if i % 10 and zlib.crc32(str(i).encode()) % 5]
    assert sorted(texts) == sorted(want)
