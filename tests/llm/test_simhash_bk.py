import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from verso.llm import simhash_bk as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType())])


def brute_components(ids, fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def plain_simhash(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_near_dedup_equals_brute_force(spark):
    rnd = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta", "été", "x", "ßz", "\x1cq", "omega", "rho"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(60)]
    texts += [t + " end" for t in texts[:30]] + texts[:10] + [None, "", " \n\t", "one two", "One  two"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "alpha", "x"), (3, texts[3], "x")]
    got = S.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    fps = [plain_simhash(t) for _, t, _ in rows]
    want = sorted(zip([r[0] for r in rows], [f"{f:016x}" for f in fps], brute_components([r[0] for r in rows], fps)), key=str)
    assert sorted([tuple(r) for r in got], key=str) == want


@pytest.mark.parametrize("blocks,max_tree", [(5, 20_000), (5, 7), (6, 20_000), (8, 20_000)])
def test_links_connect_exactly_the_pairs_within_radius(spark, blocks, max_tree):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(base) | {0}
    for b in base:
        for _ in range(rnd.randint(0, 6)):
            x = b
            for bit in rnd.sample(range(64), rnd.randint(1, 6)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    got = S.components(df, blocks=blocks, max_tree=max_tree).collect()
    want = brute_components(list(range(len(fps))), fps)
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_chunk_borders_do_not_lose_links(spark, monkeypatch):
    one = [(0, 0), (1, 1), (2, 3), (3, 255), (4, 511)]
    a, b = S._link_groups(np.array([x for _, x in one], np.uint64), np.zeros(5, np.int64), 1, np.ones(5, bool), 1)
    assert set(zip(a.tolist(), b.tolist())) == {(1, 0), (3, 0), (511, 255)}


def test_empty_table_and_keep_first(spark):
    empty = spark.createDataFrame([], DOCS)
    assert S.near_dedup(empty).count() == 0
    assert S.keep_first(empty).count() == 0
    rows = [(7, "a b c d e f", "p"), (2, "a b c d e f", "q"), (2, "a b c d e f", "q"), (9, "other words in this one here", None), (None, "lone", None)]
    kept = S.keep_first(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]


@pytest.mark.parametrize("hot_keys", [1, 4, 1000])
def test_star_merge_with_a_hot_centre(spark, monkeypatch, hot_keys):
    """A centre with most of the links, a chain through it and small groups."""
    monkeypatch.setattr(S, "HOT_KEYS", hot_keys)
    rnd = random.Random(12)
    pairs = [(500, i) for i in range(600, 900)] + [(i, i + 1) for i in range(40)] + [(40, 500)] + [(1000 + 3 * i, 1001 + 3 * i) for i in range(30)]
    rnd.shuffle(pairs)
    edges = spark.createDataFrame([p if rnd.random() < 0.5 else p[::-1] for p in pairs], "a long, b long").repartition(5)
    got = {r.a: r.b for r in S.merged(edges).collect()}
    want = {i: 0 for i in [*range(1, 41), 500, *range(600, 900)]} | {1001 + 3 * i: 1000 + 3 * i for i in range(30)}
    assert got == want


@pytest.mark.parametrize("hot_keys", [1, 5])
def test_large_component_and_long_text(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(S, "HOT_KEYS", hot_keys)
    rnd = random.Random(2)
    base = rnd.getrandbits(63)
    fps = [base ^ (1 << rnd.randrange(63)) for _ in range(200)] + [rnd.getrandbits(63) for _ in range(30)]
    ids = [*range(100, 330)]
    got = {r.doc_id: r.component_id for r in S.components(spark.createDataFrame(list(zip(ids, fps)), "doc_id long, fp long")).collect()}
    assert got == dict(zip(ids, brute_components(ids, fps)))
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = S.near_dedup(spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.component_id, r.fingerprint) for r in sorted(rows)] == [(i, 1, f"{plain_simhash(long):016x}") for i in (1, 2)]
    assert S.near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
