import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from verso.llm import common, queries
from verso.llm import hmm_lm as H

SF = "/root/testdata/sf0.001"


def small_model(rng, k=3, m=5):
    norm = lambda a, ax: a / a.sum(axis=ax, keepdims=True)
    return H.Model(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((m, k)), 0))


def paths_likelihood(model, seq):
    """Sum over every path of states."""
    k = len(model.start)
    p = {(): 1.0}
    total = {s: model.start[s] * model.emit[seq[0], s] for s in range(k)}
    for o in seq[1:]:
        total = {s: sum(total[r] * model.move[r, s] for r in range(k)) * model.emit[o, s] for s in range(k)}
    assert p
    return math.log10(sum(total.values()))


def test_forward_is_exact_for_ragged_texts():
    rng = np.random.default_rng(3)
    model = small_model(rng)
    texts = [rng.integers(0, 5, n) for n in (1, 7, 3, 40, 1, 12)]
    got = H.log10_likelihoods(model, texts)
    assert np.allclose(got, [paths_likelihood(model, t.tolist()) for t in texts])
    long = H.log10_likelihoods(model, [rng.integers(0, 5, 50_000)])
    assert np.isfinite(long).all()


def test_expected_counts_equal_all_paths():
    import itertools

    rng = np.random.default_rng(4)
    model = small_model(rng)
    texts = [rng.integers(0, 5, n) for n in (4, 2, 1, 5)]
    start, move, emit, ll = H.expected_counts(model, texts, np.ones(4, bool))
    s, m, e, total = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for t in texts:
        weights = {}
        for path in itertools.product(range(3), repeat=len(t)):
            p = model.start[path[0]] * model.emit[t[0], path[0]]
            for i in range(1, len(t)):
                p *= model.move[path[i - 1], path[i]] * model.emit[t[i], path[i]]
            weights[path] = p
        z = sum(weights.values())
        total += math.log10(z)
        for path, p in weights.items():
            s[path[0]] += p / z
            for i in range(len(t)):
                e[t[i], path[i]] += p / z
                if i:
                    m[path[i - 1], path[i]] += p / z
    same = lambda a, b: np.allclose(a, b, rtol=1e-4, atol=1e-5)  # noqa: E731  single precision
    assert same(start, s) and same(move, m) and same(emit, e) and math.isclose(ll, total, rel_tol=1e-5)


def brute_base(rows):
    tok = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in rows if not held(d) for w in tok(t))
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        ws = tok(t)
        out.append((d, held(d), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)))
    return out


@pytest.mark.parametrize("head", [H.HEAD, 50])
def test_base_equals_brute_force_and_model_is_better(spark, head):
    docs = common.documents(spark, SF)
    extra = spark.createDataFrame([(10**9 + i, t, "x") for i, t in enumerate([None, "", "Zz zz", "the the", "été"])] + [(None, "alone", "x")], "doc_id long, text string, score string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = H.score(docs, common.is_held_out("doc_id", 7), head=head, own=min(head, 300), iterations=3, states=4).collect()
    a = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    b = sorted(brute_base(rows), key=str)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert np.allclose([x[5] for x in a], [x[5] for x in b])
    assert all(r.score < 0 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_one_class_words_sum_to_at_most_one(spark):
    docs = common.documents(spark, SF)
    counts = H.word_counts(docs)
    v = H.Vocabulary(counts, head=200, own=50)
    own = {w for w, i in v.index.items() if i < v.own}
    mass = Counter()
    for r in counts.collect():
        if bytes(r.word) not in own:
            mass[r.cls] += (r.c + 1) / v.class_size[r.cls]
    assert all(m < 1 for m in mass.values())
    assert abs(v.unigram().sum() - 1) < 1e-9


def test_baum_welch_raises_the_likelihood(spark):
    docs = common.documents(spark, SF)
    v = H.Vocabulary(H.word_counts(docs), head=500, own=200)
    enc = H.encode(docs, v, F.lit(False)).cache()
    ll = [sum(r.symbol_score for r in H.likelihoods(enc, H.fit(enc, v.unigram(), 4, n)).collect()) for n in (0, 1, 3)]
    assert ll[0] < ll[1] < ll[2]


def test_no_training_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = H.score(df, F.lit(True), states=2, iterations=1).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert queries.hmm_lm.score(df.limit(0), F.lit(False), states=2, iterations=1).count() == 0
