"""Benchmark decontamination against brute force over all windows of all texts."""

import hashlib
import random
import re

import pytest
from oracle_compare import connect, differences

from fareloom.llm import decontaminate, oracle
from fareloom.llm.queries import op12_decontaminate

SF_DIR = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=10):
    """(doc_id, n_words, n_hit, items) of each document."""
    windows = {}
    for item, text in items:
        ws = words(text)
        size = min(width, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                if (own := windows.get(tuple(ws[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    found |= own
        out.append((doc, len(ws), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def rows_of(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.items) for r in df.collect()], key=str)


def tables(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ärger", "été", "中文", "\U0001f600", "x1y"]
    text = lambda n: "".join(w + rng.choice([" ", ", ", "\n", ". ", " - "]) for w in rng.choices(vocabulary, k=n))
    items = [(k, text(rng.choice([0, 1, 3, 4, 9, 12, 30]))) for k in range(12)] + [(3, text(14)), (None, text(6)), (20, None)]
    docs = [(0, None), (1, ""), (2, "?! ,"), (2, "?! ,"), (None, text(30)), (None, text(30))]
    for k in range(3, 60):
        part = rng.choice(items)[1] or ""
        cut = part[rng.randrange(max(1, len(part) // 3)) :] if rng.random() < 0.5 else part
        docs.append((rng.choice([k, k - 1]), text(rng.randrange(30)) + rng.choice(["", part.upper(), cut, cut + cut]) + text(rng.randrange(9))))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("set_size", [decontaminate.SET_SIZE, 7])
def test_equals_brute_force(spark, seed, set_size):
    docs, items = tables(seed)
    found = decontaminate.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 4, set_size)
    assert rows_of(found) == sorted(brute(docs, items, 4), key=str)
    assert any(n for _, _, n, _ in brute(docs, items, 4))


def test_spans_cover_the_hit_words(spark):
    docs, items = tables(4)
    found = decontaminate.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 4).collect()
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame(rows, kind) for rows, kind in zip(tables(1), (DOCS, ITEMS), strict=True))
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}
    assert {r.n_hit for r in decontaminate.decontaminate(docs, spark.createDataFrame([(1, " .")], ITEMS)).collect()} == {0}


def test_documents_or_words_go(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], ITEMS)
    passage = "One, two three four\nfive six seven eight nine TEN"
    docs = spark.createDataFrame(
        [(1, f"Start here. {passage}! And on.", 5), (2, "one two three.", 6), (3, passage, 7), (4, None, 8), (5, f"({passage})", 9)],
        f"{DOCS}, N_HIT int",
    )
    rest = decontaminate.remove_hits(docs, items)
    assert rest.columns == ["doc_id", "text"]
    assert dict(map(tuple, rest.collect())) == {1: "Start here! And on.", 2: "one two three.", 3: "", 4: None, 5: ")"}
    assert sorted(r.doc_id for r in decontaminate.drop_hit(docs, items).collect()) == [2, 4]
    assert sorted(r.doc_id for r in decontaminate.drop_hit(docs, items, share=0.8).collect()) == [1, 2, 4]


def test_a_very_long_text(spark):
    item = " ".join(f"q{k}" for k in range(10))
    text = ("a " * 200_000) + item + ("\n" * 100_000) + item
    docs, items = spark.createDataFrame([(1, text)], DOCS), spark.createDataFrame([(7, item)], ITEMS)
    assert rows_of(decontaminate.decontaminate(docs, items)) == [(1, 200_020, 20, ["7"])]
    assert decontaminate.remove_hits(docs, items).first().text == ("a " * 200_000)[:-1]


def test_a_window_that_everything_shares(spark):
    """Thousands of documents and hundreds of items with one passage, in copies and not."""
    passage = " ".join(f"p{k}" for k in range(12))
    items = [(k, f"i{k} {passage}") for k in range(300)]
    docs = [(k, f"{passage} d{k % 50}") for k in range(3000)]
    found = decontaminate.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert {(r.n_words, r.n_hit, r.n_items) for r in found.collect()} == {(13, 12, 300)}


def test_the_plan_runs_no_python(spark, plan):
    docs, items = (spark.createDataFrame(rows, kind) for rows, kind in zip(tables(1), (DOCS, ITEMS), strict=True))
    text = plan(decontaminate.decontaminate(docs, items)) + plan(decontaminate.remove_hits(docs, items))
    cut = decontaminate._windows(decontaminate._cut(docs, "doc_id"), [10])
    text += plan(cut) + plan(decontaminate.item_windows(items))
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_query_over_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = [
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)
    ]
    got = op12_decontaminate(spark, SF_DIR).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(row[5] for row in want)


def test_query_equals_its_sql(spark):
    assert differences(op12_decontaminate(spark, SF_DIR), connect(SF_DIR), oracle.SQL["op12_decontaminate"]) == []
