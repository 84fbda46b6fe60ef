"""LM scores against counts kept in dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fareloom.llm import lm
from fareloom.llm.queries import op7_lm

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def fold(doc_id):
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def count(rows, wanted):
    words, pairs, docs = Counter(), Counter(), 0
    for i, text in rows:
        if wanted(fold(i)):
            ts = tokens(text)
            words.update(ts)
            pairs.update(zip(["<s>", *[(t,) for t in ts]], ts))
            docs += 1
    return words, pairs, docs


def brute(rows):
    words, pairs, docs = count(rows, lambda f: f != 1)
    main_words, main_pairs, main_docs = count(rows, lambda f: f not in (0, 1))
    n, v, n_main = sum(words.values()), len(words), sum(main_words.values())

    def estimates(ts, words, pairs, docs):
        for h, w in zip(["<s>", *[(t,) for t in ts]], ts):
            context = docs if h == "<s>" else words[h[0]]
            yield words[w], pairs[h, w] / max(1, context), context

    cells = Counter()
    for i, text in rows:
        if fold(i) == 0:
            for own, after, context in estimates(tokens(text), main_words, main_pairs, main_docs):
                cells[int(lm.bucket_of(np.array(context))), int(lm._bin(np.array(after))), int(lm._bin(np.array(own / max(1, n_main))))] += 1
    weights = lm.learn_weights(np.array([(*k, c) for k, c in cells.items()], np.int64).reshape(-1, 4), 1 / (v + 1))
    out = []
    for i, text in rows:
        ts = tokens(text)
        base = sum(math.log10((words[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        score = 0
        for own, after, context in estimates(ts, words, pairs, docs):
            w = weights[int(lm.bucket_of(np.array(context)))]
            score += math.log10(w[0] * after + w[1] * own / max(1, n) + w[2] / (v + 1))
        out.append((i, fold(i) == 1, len(ts), sum(words[t] > 0 for t in ts), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def answer(df):
    return sorted(
        ((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in lm.score_documents(df).collect()), key=str
    )


@pytest.fixture(scope="module")
def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def test_query_equals_brute_force(spark, given):
    got = sorted(((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in op7_lm(spark, SF_DIR).collect()), key=str)
    assert got == brute(given)


def test_small_chunks_give_the_same(spark, given, monkeypatch):
    rows = given[:40] + [(None, None), (7, ""), (7, "\n "), (10**15, "The the THE"), (given[0][0], given[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string").repartition(5)
    assert answer(df) == brute(rows)
    assert answer(df.limit(0)) == []
    only = next(i for i in range(100) if fold(i) == 1)
    assert answer(spark.createDataFrame([(only, "a b")], "doc_id long, text string")) == brute([(only, "a b")])


def test_held_out_text_is_likelier_under_the_mixture(spark):
    rows = [r for r in op7_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_weights_are_a_mixture():
    cells = np.array([[5, 4, 20, 10], [5, 0, 20, 30], [2, 0, 0, 7]], np.int64)
    weights = lm.learn_weights(cells, 1e-6)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[:, 2] > 0).all()
    assert weights[5][0] > 0.1 and weights[2][2] > 0.9 and (weights[9] == weights[5]).all()


def grams(rows, wanted, order):
    """How often each run of up to ``order`` tokens ends at a token, and how many documents there are."""
    counts, docs = Counter(), 0
    for i, text in rows:
        if wanted(fold(i)):
            ts = tokens(text)
            docs += 1
            for k in range(len(ts)):
                # Runs that reach before the first token hold the start, once.
                counts.update({tuple(["<s>", *ts][max(0, k + 2 - n) : k + 2]) + (n,) for n in range(1, order + 1)})
    return counts, docs


def estimated(ts, counts, docs, total, order):
    """Per token: its shares by falling length, and the level and power of two of the longest known context."""
    padded = ["<s>", *ts]
    for k in range(len(ts)):
        shares, level = [counts[ts[k], 1] / max(1, total)], (0, 0)
        for n in range(2, order + 1):
            context = docs if k == 0 else counts[tuple(padded[max(0, k + 2 - n) : k + 1]) + (n - 1,)]
            run = tuple(padded[max(0, k + 2 - n) : k + 2]) + (n,)
            shares.insert(0, counts[run] / max(1, context))
            if context:
                level = (n, context.bit_length())
        yield shares, level


def independent_scores(rows, order):
    """Scores whose weights come from EM over every held-out token's own probabilities, without a histogram."""
    counts, docs = grams(rows, lambda f: f != 1, order)
    main, main_docs = grams(rows, lambda f: f not in (0, 1), order)
    total, main_total = (sum(c for run, c in x.items() if run[-1] == 1) for x in (counts, main))
    uniform = 1 / (sum(run[-1] == 1 for run in counts) + 1)
    seen = {}
    for i, text in rows:
        if fold(i) == 0:
            for shares, level in estimated(tokens(text), main, main_docs, main_total, order):
                seen.setdefault(level, []).append([*shares, uniform])
    weights = {}
    for level, p in seen.items():
        w = [1 / (order + 1)] * (order + 1)
        for _ in range(100):
            gained = [0.0] * (order + 1)
            for line in p:
                whole = sum(a * b for a, b in zip(w, line, strict=True))
                for k, x in enumerate(line):
                    gained[k] += w[k] * x / whole
            w = [g / len(p) for g in gained]
        w = [x * len(p) / (len(p) + 1) for x in w]
        w[-1] += 1 / (len(p) + 1)
        weights[level] = w

    def mixture(level):
        """That of the nearest level below if no held-out token has this one, equal weights without any."""
        below = [x for x in weights if x <= level]
        return weights[max(below)] if below else [1 / (order + 1)] * (order + 1)

    return {
        i: sum(
            math.log10(sum(a * b for a, b in zip(mixture(level), [*shares, uniform], strict=True)))
            for shares, level in estimated(tokens(text), counts, docs, total, order)
        )
        for i, text in rows
    }


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_equal_counts_in_dictionaries_and_an_independent_em(spark, given, order):
    rows = [(i, text[:600] if text else text) for i, text in given]
    want = independent_scores(rows, order)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in lm.score_documents(df, order=order).collect()}
    assert got.keys() == want.keys()
    # The operator's EM runs on a histogram of quarter powers of two.
    assert all(abs(got[i] - s) <= 0.02 * abs(s) for i, s in want.items())
    assert abs(sum(got[i] for i in want) - sum(want.values())) <= 0.005 * abs(sum(want.values()))


def test_an_order_below_one_is_refused(spark):
    with pytest.raises(ValueError):
        lm.score_documents(spark.createDataFrame([], "doc_id long, text string"), order=0)


def test_more_buckets_give_the_same_and_their_share_is_bounded(spark, given, monkeypatch):
    df = spark.createDataFrame(given[:60], "doc_id long, text string")
    want = answer(df)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 100)
    assert answer(df) == want
    monkeypatch.undo()
    for tokens_in_all in (10**6, 5 * 10**9, 25 * 10**9, 10**13):
        assert tokens_in_all / lm.bucket_count(200, tokens_in_all) <= lm.BUCKET_TOKENS
