"""Mixing against water-filling by hand and against SQL."""

import random

import pytest
from oracle_compare import connect, differences

from fareloom.llm import mixing, oracle
from fareloom.llm.queries import op6_mixing

SF_DIR = "/root/testdata/sf0.001"


def targets(sizes, weights, share, epochs):
    total = share * sum(sizes)
    clamped = set()
    while True:
        free = sum(w for k, w in enumerate(weights) if k not in clamped)
        rest = total - sum(epochs * sizes[k] for k in clamped)
        level = rest / free if free else 0
        above = {k for k, w in enumerate(weights) if k not in clamped and w * level > epochs * sizes[k]}
        if not above:
            return [epochs * s if k in clamped else weights[k] * level for k, s in enumerate(sizes)]
        clamped |= above


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    names = [None, "ä", "B", "a", "zz", "é", "src10", "src9"][: 3 + 2 * seed]
    rows = [
        (k, rng.choices(names, [0.5 ** (i % 5) for i in range(len(names))])[0], "w " * rng.randint(0, 60))
        for k in range(400)
    ]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df).collect()
    used = sorted({n for _, n, _ in rows}, key=lambda n: (n is None, (n or "").encode()))
    sizes = [sum(len(t.split()) for _, n, t in rows if n == name) for name in used]
    want = targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(used))], 1.5, 2)
    assert len(got) == len(rows)
    for name, size, target in zip(used, sizes, want, strict=True):
        own = [r for r in got if r.source == name]
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(size, round(target, 6))}
        assert abs(sum(r.taken for r in own) - target) <= 1
        assert all(r.taken <= 2 * r.size for r in own)
        whole = int(target // size) if size else 0
        assert sum(r.taken not in (whole * r.size, (whole + 1) * r.size) for r in own) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_sources_are_ranked_across_partitions(spark):
    df = spark.range(1000).selectExpr("lpad(string(id * 7919 % 1000), 4, '0') AS name")
    got = mixing.ranked(df.repartition(9), "name").collect()
    assert all(int(r.name) == r.rank for r in got) and len(got) == 1000


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, 1), (1, "a", "x y", 2), (1, "a", "x y", 2), (2, "b", "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, TAKEN int")
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "source", "text", "size", "source_size", "target", "taken"]
    got = sorted((r.doc_id or 0, r.size, r.source_size, r.target, r.taken) for r in out.collect())
    assert [g[:4] for g in got] == [(0, 0, 0, 0.0), (1, 2, 4, 6.0), (1, 2, 4, 6.0), (2, 0, 0, 0.0)]
    assert sum(g[4] for g in got) == 6
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix(df.where("doc_id = 2")).first().taken == 0


def test_repetition_is_the_mix(spark):
    df = spark.createDataFrame(
        [(k, "a" if k % 3 else "b", f"t{k} " * (k % 9)) for k in range(60)], "doc_id long, source string, text string"
    )
    mixed = mixing.mix(df)
    out = mixing.repeat(mixed)
    assert out.columns == df.columns
    words = out.selectExpr("source", "size(split(trim(text), ' ')) AS n").groupBy("source").sum("n").collect()
    taken = mixed.groupBy("source").sum("taken").collect()
    assert sorted(map(tuple, words)) == sorted(map(tuple, taken))


def test_query_equals_its_sql(spark):
    assert differences(op6_mixing(spark, SF_DIR), connect(SF_DIR), oracle.SQL["op6_mixing"]) == []
