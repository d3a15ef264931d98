"""Spelling variants: brute force over all edits of a word, any sharding."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.llm import spelling_variants as V
from verso.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(rows, planted=True):
    out = Counter()
    for doc_id, text in rows:
        for run in LETTERS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    out.pop("", None)
    return out


def brute(counts, min_chars=5, min_count=3):
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    letters = sorted({c for w in words for c in w})
    form, rows = {}, {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + j :] for i in range(len(w) + 1) for c in letters for j in (0, 1)}
        near = [(-words[e], e) for e in edits - {w} if e in words and abs(len(e) - len(w)) < 2]
        best = min(near, default=None)
        if best and -best[0] >= 2 * n:
            form[w] = best[1]
        rows[w] = len(near)
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, n, rows[w], f, words[f] if f else None, root))
    return sorted(map(str, out))


def got(df):
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(str, map(tuple, df.collect())))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute(brute_counts([tuple(r) for r in rows]))
    assert any(int(x.split(", ")[2]) > 3 for x in want) and any("None" not in x for x in want)
    assert got(QUERIES["op12_spelling_variants"](spark, SF_SMALL)) == want


def random_counts(rng, n):
    """Words of a few letters, dense in near pairs; some accented, some very long."""
    out = {}
    for _ in range(n):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 9)))
        out[w] = rng.randrange(1, 40)
    for size in (300, 301, 700):
        for k in range(4):
            out["x" * size + "yz"[: k % 3] + "x" * (k // 2)] = rng.randrange(1, 99)
    return out


@pytest.mark.parametrize("levels,max_tree,max_queries", [(1, 20_000, 20_000), (3, 7, 5), (6, 1, 30)])
def test_any_sharding(spark, levels, max_tree, max_queries):
    counts = random_counts(random.Random(levels), 500)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(V.variants(df, 1, 1, levels=levels, max_tree=max_tree, max_queries=max_queries)) == brute(counts, 1, 1)


def test_hot_shard_and_small_slices(spark, monkeypatch):
    """Words of the same letters only: one shard, one leaf."""
    rng = random.Random(2)
    counts = {"".join(rng.sample("aabbccdd", 8)): rng.randrange(1, 50) for _ in range(400)}
    counts |= {w[:-1] + "e": 3 for w in list(counts)[:60]}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(V.variants(df, 1, 1, levels=2, max_tree=50)) == brute(counts, 1, 1)


def test_budget_of_the_search():
    """The search meets exactly the vectors within one surplus and one deficit."""
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)})
    trie = V.Trie(words, np.ones(len(words), dtype=np.int64), 6)
    met = {(q, w) for qs, ws in trie.candidates(trie.vector, True) for q, w in zip(qs.tolist(), ws.tolist())}
    for q, a in enumerate(trie.vector):
        for w, b in enumerate(trie.vector):
            if np.maximum(b - a, 0).sum() <= 1 and np.maximum(a - b, 0).sum() <= 1:
                assert (q, w) in met


def test_counts_of_cases(spark):
    """Nulls, repeated rows, extra columns, long texts cut between words."""
    rows = [(1, "Été ÉTÉ straße x×y ÷ ABC-def"), (1, "Été ÉTÉ straße x×y ÷ ABC-def"), (None, "Null ID words"), (2, None), (3, ""), (4, "中文 mixedĀLatin \U0001f600 end")]
    rows += [(5, "longword " * 200_000 + "z" * 1_500_000 + " tail"), (6, "y" * 2_200_000)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n long")
    for planted in (False, True):
        found = {r.word: r.n for r in V.word_counts(docs, planted).collect()}
        assert found == brute_counts(rows, planted)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert V.variants(V.word_counts(docs)).collect() == []


def test_chains_of_forms(spark):
    chain = [("w" + "a" * k, 3 * 2**k) for k in range(1, 14)]
    ends = {r.word: r.root for r in V.roots(spark.createDataFrame([(a[0], b[0]) for a, b in zip(chain, chain[1:])], "word string, form string")).collect()}
    assert set(ends.values()) == {chain[-1][0]} and len(ends) == 12
    assert V.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_rows_grow_with_words(spark):
    """A task sends a row for each word with a hit, not for each pair."""
    words = spark.range(2_000).select(F.concat(F.lit("common"), F.conv("id", 10, 26).cast("string")).alias("word"), (F.col("id") + 1).alias("n"))
    found = V.near(words, levels=2)
    assert found.count() <= 2_000
