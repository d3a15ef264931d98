"""Periodic runs: brute force over all periods, on texts and on the query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from verso.llm import periodic_runs as R
from verso.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=12):
    """Every period, every maximal stretch; the smallest period of an interval."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words])
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]]).astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # words a..b-1 equal those q later
            if b + q - a >= max(least, 2 * q):
                found.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(texts, least=12):
    got = R.runs_of_texts(texts, least)
    for t, (words, runs) in zip(texts, got):
        plain = WORD.findall(t or "")
        assert [w.decode() for w in words] == plain
        assert runs == brute_runs(plain, least)
        assert R.collapsed(words, runs).decode() == brute_collapsed(plain, runs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.lists(st.integers(0, 3), max_size=90)), min_size=1, max_size=6))
def test_random_texts(drawn):
    check([" ".join(f"w{x % k}" for x in xs) for k, xs in drawn])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=14), st.integers(1, 12)), min_size=1, max_size=8), st.integers(2, 14))
def test_repeated_blocks(blocks, least):
    check([" ".join(f"w{x}" for xs, k in blocks for x in xs * k)] * 2, least)


def test_shapes():
    fib = ["a"], ["b"]
    for _ in range(14):
        fib = fib[1], fib[1] + fib[0]
    rng = random.Random(5)
    block = [f"v{rng.randrange(300)}" for _ in range(400)]
    check([None, "", " \t\n", "x " * 11, "x " * 12, "a b " * 6, "a b " * 6 + "a", " ".join(fib[1]), "x " * 3000, " ".join(block * 3 + block[:37]), " ".join(block * 3 + block[:37]),
           "a b c " * 12, "été ÉTÉ " * 9, " ".join(block[:50] + ["z"] * 40 + block[:50])])


def test_thue_morse_and_long_repeats():
    """Texts on which weak hashes fail, and runs longer than the word-by-word steps."""
    tm = [0]
    for _ in range(11):
        tm += [1 - x for x in tm]
    check([" ".join("ab"[x] for x in tm), " ".join("ab"[x] for x in tm[:700] * 3)], 6)


def test_very_long_text():
    rng = random.Random(1)
    unit = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    words = unit + unit[:30_000] + ["x"] * 100_000 + unit * 2
    (_, runs), = R.runs_of_texts([" ".join(words)])
    assert (70_000, 100_000, 1) in runs and (170_000, 80_000, 40_000) in runs
    for a, n, q in runs:
        assert n >= max(12, 2 * q) and words[a : a + n - q] == words[a + q : a + n]
        assert a == 0 or words[a - 1] != words[a - 1 + q]
        assert a + n == len(words) or words[a + n] != words[a + n - q]


def test_grammar_derives_its_places():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 6, size=3000)
    doc = np.repeat(np.arange(3), 1000)
    start, middle, end, places, first = R.grammar(ids, doc).done()
    for s, m, e, a, b in zip(start, middle, end, first[:-1], first[1:]):
        assert s < m < e and len(set(doc[s:e])) == 1
        for p in places[a:b]:
            assert (ids[p : p + e - s] == ids[s:e]).all()
    assert {(0, 1000), (1000, 2000), (2000, 3000)} <= set(zip(start.tolist(), end.tolist()))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute_row(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    top = min(((-n, a, q) for a, n, q in runs), default=None)
    best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest())


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_periodic_runs"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(got) == sorted(str(brute_row(r.doc_id, r.text)) for r in docs)


@pytest.mark.parametrize("block_words", [1, 50, 10_000])
def test_cases_and_blocks(spark, block_words):
    """Nulls, ties, repeated rows and ids, clashing columns, any block size."""
    rows = [(i % 40, " ".join(f"w{(i * j) % 7}" for j in range(i % 60)), "x") for i in range(120)]
    rows += [(None, "a " * 20, None), (3, None, "y"), (4, "", "y"), (4, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = R.find(R.with_planted_runs(docs), block_words=block_words)
    assert rows_of(R.digests(found)) == sorted(str(brute_row(d, t)) for d, t, _ in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.digests(R.find(R.with_planted_runs(docs))).collect() == []
