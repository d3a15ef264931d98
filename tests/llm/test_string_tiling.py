import random
import tracemalloc

from verso.llm import common, queries, seeds
from verso.llm import string_tiling as G
from verso.llm.seeds import words


def brute_tiles(doc, item, k):
    """Textbook greedy string tiling, one longest match after another."""
    md, mi, out = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in mi and j + n not in md:
                    n += 1
                if n >= k and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return sorted(out)
        n, i, j = -best[0], best[1], best[2]
        out.append((i, j, n))
        mi |= set(range(i, i + n))
        md |= set(range(j, j + n))


def brute_leaks(docs, items, threshold, k):
    out = set()
    for d, t in docs:
        for q, it in items:
            item = words(it)
            if len(item) >= k:
                got = brute_tiles(words(t), item, k)
                if sum(n for *_, n in got) / len(item) >= threshold:
                    out.add((d, q, tuple(got)))
    return out


def test_equals_brute_force(spark):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(9)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(3, 26)))) for i in range(12)] + [(50, None), (51, ""), (None, "a b c d e f g")]
    docs = []
    for d in range(60):
        src = words(items[rnd.randrange(12)][1])
        cut = rnd.randint(0, len(src))
        fill = [rnd.choices(vocab, k=rnd.randint(0, 8)) for _ in range(3)]
        docs.append((d, " ".join([*fill[0], *src[cut:], *fill[1], *src[:cut], *fill[2]]) + "."))
    docs += [(None, items[4][1]), (3, docs[3][1]), (90, None), (91, ""), (92, "A b, c d e; f G")]
    ddf = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, coverage int")
    bdf = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for block_words in (10**6, 60):
        got = G.leaks(ddf, bdf, 0.6, 4, block_words).collect()
        assert {(r.doc_id, r.item_id, tuple(tuple(x) for x in r.tiles)) for r in got} == brute_leaks(docs, items, 0.6, 4)
        kept = G.clean(ddf, bdf, 0.6, 4, block_words)
        assert kept.columns == ["doc_id", "text", "coverage"]
        bad = {(d, t) for d, t in docs if any(x[0] == d for x in brute_leaks([(d, t)], items, 0.6, 4))}
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in docs if x not in bad), key=str)


def test_reordered_passage_counts_in_full(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    doc = "seven eight nine ten eleven twelve and then one two three four five six"
    ddf, bdf = spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")
    r = G.leaks(ddf, bdf).first()
    assert (r.coverage, r.n_tiles, r.matched_words) == (1.0, 2, 12)
    assert G.leaks(ddf.limit(0), bdf).count() == 0 and G.leaks(ddf, bdf.limit(0)).count() == 0
    assert G.clean(ddf, bdf.limit(0)).count() == 1


def test_registered_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in common.documents(spark, sf).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    near = [(d, t) for d, t in docs if any(" ".join(words(it)[:5]) in " ".join(words(t)) for _, it in items)]
    got = {(r.doc_id, r.item_id, tuple(tuple(x) for x in r.tiles)) for r in queries.op7_string_tiling(spark, sf).collect()}
    assert got >= brute_leaks([(d, t) for d, t in near if len(t) < 6000], items, 0.8, 5)
    for d, q, ts in got:
        text, item = words(dict(docs)[d]), words(dict(items)[q])
        assert all(text[j : j + n] == item[i : i + n] for i, j, n in ts)


def test_repeated_words_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        letters = rnd.choice(["a", "ab", "abc"])
        items = [" ".join(rnd.choices(letters, k=rnd.randint(4, 14))) for _ in range(3)]
        docs = [" ".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(3)]
        seeds.PAIRS_AT_ONCE, before = rnd.choice([1, 7, 1 << 18]), seeds.PAIRS_AT_ONCE
        try:
            got = {(d, i, tuple(t)) for d, i, _, t in G._found(seeds.Block(items, 4), docs, 0.5)}
        finally:
            seeds.PAIRS_AT_ONCE = before
        assert got == brute_leaks(list(enumerate(docs)), list(enumerate(items)), 0.5, 4)


def test_memory_of_a_long_repeated_text():
    """80,000 times one word against items of 200 such words: seeds are 15.7 million pairs
    an item."""
    block = seeds.Block(["w " * 200, "w " * 200 + "end of the item here", "other words that no text holds"], 5)
    text = "w " * 80_000
    tracemalloc.start()
    got = list(G._found(block, [text], 0.8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(i, c) for _, i, c, _ in got] == [(0, 1.0), (1, 200 / 205)]
    assert peak < 100e6
