import zlib

import numpy as np

from verso.llm import common, queries
from verso.llm import hd_langid as H

SF = "/root/testdata/sf0.001"


def brute_vector(text, dim):
    """Bundle of bound, permuted letter vectors, one n-gram at a time."""
    letters, s = H.Space(dim), " "
    for c in text:
        s += c.lower()[0] if c.isalpha() else " "
    s = " ".join(s.split(" ")).replace("\n", " ")
    out = [0]
    for c in s:
        code = ord(c) if c != " " else 0
        if code or out[-1]:
            out.append(code)
    if out[-1]:
        out.append(0)
    total = np.zeros(dim)
    for i in range(len(out) - H.N + 1):
        v = np.ones(dim)
        for place in range(H.N):
            v = v * np.roll(letters.letter(out[i + place]), place)
        total += v
    return total


def test_vectors_equal_one_at_a_time():
    texts = ["It's a  test, été!", "", "a", "12 34", "ñandú " * 30, "漢字かな mixed"]
    own = H.Space(64)
    for t, (k, n) in zip(texts, H.gram_counts(texts, own)):
        got = n.astype(float) @ own.vectors[own.grams(k)] if len(k) else np.zeros(64)
        assert np.allclose(got, brute_vector(t, 64)), t


def test_small_cache_changes_nothing(monkeypatch):
    texts = ["the quick brown fox", "jumps over the lazy dog"]
    want = [n @ o.vectors[o.grams(k)] for o in [H.Space(64)] for k, n in H.gram_counts(texts, o)]
    monkeypatch.setattr(H, "_CACHED_GRAMS", 40)
    o = H.Space(64)
    got = [n @ o.vectors[o.grams(k)] for k, n in H.gram_counts(texts, o)]
    assert np.allclose(want, got)


def test_held_out_accuracy(spark):
    got = queries.op1_hd_langid(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in common.documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en", 0.1), (2, "le chat et le chien", "fr", None), (None, "the cat", "en", 1.0), (4, None, None, 1.0),
            (5, "", "en", 1.0), (6, "123 !?", "fr", 1.0), (7, "le chat", None, 1.0), (1, "the cat and the dog", "en", 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = H.train(df)
    got = [(r.doc_id, r.lang_pred) for r in H.predict(df, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (2, "fr"), (None, "en"), (4, "und"), (5, "und"), (6, "und"), (7, "fr"), (1, "en")], key=str)
    assert H.train(df.limit(0)) == {}
    assert {r.lang_pred for r in H.predict(df, {}).collect()} == {"und"}
    assert H.predict(df.limit(0), model).count() == 0
