"""Spelling variants against brute force over all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle_compare import connect, differences

from fareloom.llm import oracle, spelling
from fareloom.llm.queries import op11_spelling
from fareloom.llm.shingles import Powers

SF_DIR = "/root/testdata/sf0.001"


def edits(word, alphabet):
    out = set()
    for k in range(len(word) + 1):
        out |= {word[:k] + c + word[k:] for c in alphabet}
        if k < len(word):
            out |= {word[:k] + c + word[k + 1 :] for c in alphabet} | {word[:k] + word[k + 1 :]}
    return out - {word}


def counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute(n_of, ratio=10):
    alphabet, out, forms = sorted(set("".join(n_of))), [], {}
    for word, n in n_of.items():
        near = [w for w in edits(word, alphabet) if w in n_of]
        best = min(near, key=lambda w: (-n_of[w], w), default=None)
        forms[word] = (best if near and n_of[best] >= ratio * n else None, len(near))
    for word, (form, n_near) in forms.items():
        root = word
        while forms[root][0] is not None:
            root = forms[root][0]
        out.append((word, form, root, n_of[word], n_near, n_of[form] if form else None))
    return sorted(out)


def sorted_rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def words(seed):
    rng = random.Random(seed)
    out, letters = {}, "abcdeéÿ中\U0001f600"
    for _ in range(30):
        word, n = "".join(rng.choices(letters[: rng.choice([2, 6, 9])], k=rng.randint(1, 12))), 10 ** rng.randint(1, 6)
        for _ in range(30):
            out.setdefault(word, n)
            word = rng.choice(sorted(edits(word, letters))) or word
            n = max(2, n // rng.choice([1, 5, 10, 11, 30]))
    return out


@pytest.mark.parametrize("seed, n_symbols, set_size", [(1, None, spelling.SET_SIZE), (2, 1, 0), (3, 7, 0)])
def test_equals_brute_force(spark, seed, n_symbols, set_size):
    n_of = words(seed)
    df = spark.createDataFrame(list(n_of.items()), "word string, n long")
    got = sorted_rows(spelling.variants(df, n_symbols=n_symbols, set_size=set_size))
    assert got == brute(n_of)
    assert any(r[1] != r[2] and r[1] for r in got)


def test_neighbourhoods_are_full_and_without_repeats():
    rng, powers = random.Random(4), Powers()
    forms = [bytes(rng.choices(range(1, 4), k=n)) for n in (0, 1, 2, 3, 7, 12) for _ in range(5)]
    held = spelling.Reduced(np.frombuffer(b"".join(forms), np.uint8), np.array([len(f) for f in forms]), powers)
    found = [[] for _ in forms]
    for word, keys in held.neighbours(3):
        for w, key in zip(word.tolist(), keys.tolist(), strict=True):
            found[w].append(key)
    for form, keys in zip(forms, found, strict=True):
        around = [form, *{bytes(map(ord, s)) for s in edits("".join(map(chr, form)), "\x01\x02\x03")}]
        if b"" in around:
            around.remove(b"")
            around.append(b"")
        own = spelling.Reduced(np.frombuffer(b"".join(around), np.uint8), np.array([len(f) for f in around]), powers)
        assert sorted(keys) == sorted(own.keys().tolist())


def test_words_of_documents(spark):
    rng = random.Random(5)
    vocabulary = ["Überfall", "straße", "Straßen", "naïveté", "wordlike", "WORDLIKE", "abc", "ab1cdefghi", "aaaaaaaa", "œuvrelike"]
    rows = [(None, None), (1, ""), (None, "wordlike, Wordlike"), (2, "!!")]
    rows += [(rng.choice([k, 7]), " ".join(rng.choices(vocabulary, k=60))) for k in range(40)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, N int, word string")
    found = spelling.vocabulary(spelling.misspelt(spelling.runs_of(df)))
    assert {r.word: r.n for r in found.collect()} == counts(rows)
    assert sorted_rows(spelling.variants(found)) == brute(counts(rows))
    assert spelling.variants(found.limit(0)).count() == 0


def test_a_chain_of_forms_and_a_tie(spark):
    n_of = {"abcdefg": 10**6, "abcdefgh": 10**5, "abcdefghi": 10**4, "abcdefghij": 10**3, "zzzzzzz": 20, "zzzzzza": 20, "zzzzzz": 2}
    df = spark.createDataFrame(list(n_of.items()), "word string, n long")
    got = {r[0]: r for r in sorted_rows(spelling.variants(df))}
    assert got["abcdefghij"][1:3] == ("abcdefghi", "abcdefg")
    assert got["zzzzzz"][1:3] == ("zzzzzza", "zzzzzza") and got["zzzzzzz"][1] is None
    with pytest.raises(ValueError):
        spelling.variants(df, ratio=1)


def test_a_very_long_word_and_text(spark):
    long = "ab" * 100_000
    rows = [(1, f"{long} {long}x"), (2, f"{long} {long}x"), (3, "wordlike " * 200_000), (4, "wordlik wordlik" * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(spelling.variants(spelling.vocabulary(spelling.misspelt(spelling.runs_of(df))))) == brute_long(counts(rows))


def brute_long(n_of):
    """As brute, with one pair of long words that differ in the last letter."""
    longs = sorted((w for w in n_of if len(w) > 1000), key=len)
    out = brute({w: n for w, n in n_of.items() if len(w) <= 1000})
    near = len(longs) == 2 and longs[1][:-1] == longs[0]
    return sorted(out + [(w, None, w, n_of[w], int(near), None) for w in longs])


def test_one_reduced_form_for_all_words(spark):
    """Thousands of words that four symbols reduce to one form take a larger alphabet; with four all are verified."""
    rng = random.Random(6)
    n_of = {"".join(rng.choices("ae", k=12)): rng.choice([2, 30, 400]) for _ in range(3000)}
    df = spark.createDataFrame(list(n_of.items()), "word string, n long")
    want = brute(n_of)
    assert sorted_rows(spelling.variants(df, n_symbols=4)) == want
    assert sorted_rows(spelling.variants(df)) == want
    assert spelling.coded_words(df)[0].select("key").distinct().count() == len(n_of)


def test_query_over_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted_rows(op11_spelling(spark, SF_DIR)) == brute(counts(rows))


def test_query_equals_its_sql(spark):
    assert differences(op11_spelling(spark, SF_DIR), connect(SF_DIR), oracle.SQL["op11_spelling"]) == []
