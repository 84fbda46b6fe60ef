"""Exact top-k over binary codes against brute force and against SQL."""

import random
from itertools import combinations

import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F

from fareloom.llm import hamming, oracle
from fareloom.llm.queries import op8_hamming_search

SF_DIR = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(rows, k, asks):
    codes = {}
    for i, c in rows:
        if i is not None and c is not None and asks(i):
            codes[i] = min(c, codes.get(i, c))
    out = []
    for q, code in codes.items():
        near = sorted(((c ^ code) & (2**64 - 1)).bit_count() * 10**6 + i for i, c in rows if c is not None and i not in (None, q))
        out += [(q, r + 1, x % 10**6, x // 10**6) for r, x in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "n", "spread"), [(1, 300, 64), (2, 300, 3), (3, 40, 64), (4, 6, 64)])
def test_equals_brute_force(spark, seed, n, spread):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    rows = []
    for i in range(n):
        code = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, spread)):
            code ^= 1 << b
        rows.append((i, signed(code)))
    rows += [(None, 1), (5, None), (3, rows[3][1]), (3, rows[3][1]), (0, rows[0][1])]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, code long, distance int").repartition(3)
    got = hamming.top_k(df, F.col("vec_id") % 10 == 0, k=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, lambda i: i % 10 == 0)


def test_empty_and_lonely(spark):
    df = spark.createDataFrame([(0, 5)], "vec_id long, code long")
    assert hamming.top_k(df, F.col("vec_id") >= 0).count() == 0
    assert hamming.top_k(df.limit(0), F.col("vec_id") >= 0).count() == 0


def test_segments_cover_the_code():
    for n in (0, 1, 2, 10, 1000, 10**6, 10**12):
        widths = hamming.segment_widths(n)
        assert sum(widths) == 64 and max(widths) - min(widths) <= 1
    assert len(hamming.segment_widths(60_000)) == 4


def test_steps_meet_every_code_they_cover():
    widths = [3, 3, 2]
    probed = set()
    for radius, numbers, covered in hamming.search_steps(widths):
        probed |= {(n, radius) for n in numbers}
        for code in range(256):
            parts = [(code & 7).bit_count(), (code >> 3 & 7).bit_count(), (code >> 6).bit_count()]
            if code.bit_count() <= covered:
                assert any((n, d) in probed for n, d in enumerate(parts))


def test_probes_are_all_values_within_the_radius(spark):
    widths, code = [33, 16, 15], signed(0xF0E1D2C3B4A59687)
    asking = spark.createDataFrame([(code,)], "query long")
    for radius, probed in ((0, range(3)), (1, range(3)), (2, range(1, 3)), (3, range(1, 2)), (15, range(1, 3)), (16, range(1, 3)), (17, range(1, 3))):
        got = sorted((r.segment, r.value) for r in hamming.probes(asking, widths, probed, radius).collect())
        want, at = [], 0
        for n, width in enumerate(widths):
            value = (code & (2**64 - 1)) >> at & ((1 << width) - 1)
            if n in probed:
                want += [(n, value ^ sum(1 << b for b in bits)) for bits in combinations(range(width), radius)]
            at += width
        assert got == sorted(want), radius


def test_a_code_takes_a_vector_of_its_length(spark):
    vectors = [[1.0] * 64, [-1.0] * 63 + [1.0], [0.0] * 64, [1.0] * 65, [1.0] * 63, [], None, [None] * 64]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "k int, v array<float>")
    got = {r.k: r.code for r in df.select("k", hamming.sign_code(F.col("v")).alias("code")).collect()}
    assert got == {0: -1, 1: signed(1 << 63), 2: 0, 3: None, 4: None, 5: None, 6: None, 7: 0}


def test_no_broadcast_is_asked_for_the_flips(spark):
    asking = spark.createDataFrame([(5,)], "query long")
    plan = hamming.probes(asking, [32, 32], range(2), 6)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" in plan


def test_probes_are_not_gathered_on_the_driver(spark, tmp_path, plan):
    """Radius 4 makes 72,000 probes of one query, which statistics take for one row."""
    spark.createDataFrame([(5,)], "query long").write.parquet(f"{tmp_path}/asking")
    entries = ["id AS code", "1L AS rows", "CAST(id % 2 AS int) AS segment", "id AS value"]
    spark.range(1000).selectExpr(*entries).write.parquet(f"{tmp_path}/index")
    asking, index = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("asking", "index"))
    found = hamming.candidates(hamming.probes(asking, [32, 32], range(2), 4), index)
    assert "Broadcast" not in plan(found) and "SortMergeJoin" in plan(found)
    want = [(5, c, 1, (5 ^ c).bit_count()) for c in range(1000) if ((5 if c % 2 == 0 else 0) ^ c).bit_count() == 4]
    assert sorted(map(tuple, found.collect())) == want


def test_query_equals_its_sql(spark):
    assert differences(op8_hamming_search(spark, SF_DIR), connect(SF_DIR), oracle.SQL["op8_hamming_search"]) == []
