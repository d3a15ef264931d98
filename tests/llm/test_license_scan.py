import random

import numpy as np

from verso.llm import common, queries
from verso.llm import license_scan as L
from verso.llm.seeds import Block, words

SF = "/root/testdata/sf0.01"


def full_align(template, doc):
    """Best (score, matched) of the whole template anywhere, without a band."""
    row = [(0, 0)] * (len(doc) + 1)
    for w in template:
        new = [(row[0][0] - 1, row[0][1])]
        for j in range(1, len(doc) + 1):
            s, m = row[j - 1]
            new.append(max((s + 1, m + 1) if doc[j - 1] == w else (s - 1, m), (row[j][0] - 1, row[j][1]), (new[-1][0] - 1, new[-1][1])))
        row = new
    return max(row)


def test_align_equals_full_table_inside_the_band():
    rnd = random.Random(6)
    for _ in range(80):
        t = [rnd.randint(1, 6) for _ in range(rnd.randint(3, 12))]
        noisy = [w for w in t if rnd.random() > 0.15]
        pre = [rnd.randint(1, 6) for _ in range(rnd.randint(0, 9))]
        doc = np.array(pre + noisy + [rnd.randint(1, 6) for _ in range(rnd.randint(0, 9))])
        matched, a, b = L.align(np.array(t), doc, 0, band=60)
        assert matched == full_align(t, doc.tolist())[1]
        assert 0 <= a <= b <= len(doc)


def test_winnow_guarantee():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 50, 300, dtype=np.uint64)
    kept = set(L.winnow(h, 4).tolist())
    assert all(kept & set(range(i, i + 4)) for i in range(297))
    assert L.winnow(h[:2], 4).tolist() and not len(L.winnow(h[:0], 4))


def test_every_notice_line_is_found(spark):
    notices = {k: v for k, v in L.TEMPLATES.items() if len(words(v)) < 14}
    got = {(r.doc_id, r.license): r for r in queries.op9_license_scan(spark, SF).collect()}
    docs = {r.doc_id: r.text for r in common.documents(spark, SF).collect()}
    hits = 0
    for d, t in docs.items():
        for name, n in notices.items():
            if n in t:
                hits += 1
                r = got[(d, name)]
                assert r.coverage == 1.0 and words(t[r.start : r.stop]) == words(n)
    assert hits > 20
    for (d, name), r in got.items():  # nothing is reported without the words
        assert r.coverage >= 0.8
        assert len(set(words(docs[d][r.start : r.stop])) & set(words(L.TEMPLATES[name]))) >= 0.7 * len(set(words(L.TEMPLATES[name])))


def test_edited_long_text_and_edges(spark):
    mit = L.TEMPLATES["mit"].split()
    edited = " ".join(w for i, w in enumerate(mit) if i % 17 != 5)
    rows = [(1, "intro İ words " + edited + " tail", 1), (2, None, 1), (3, "", 1), (None, "All rights\nRESERVED!", 1), (5, "all rights", 1), (6, "All rights reserved. x All rights reserved.", 1), (7, "rights reserved all", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, coverage int")
    got = sorted(((r.doc_id, r.license, round(r.coverage, 2), r.start, r.stop) for r in L.scan(df).collect()), key=str)
    assert [(g[0], g[1]) for g in got] == [(1, "mit"), (6, "all-rights-reserved"), (6, "all-rights-reserved"), (None, "all-rights-reserved")]
    assert 0.9 < got[0][2] < 1 and rows[0][1][got[0][3] : got[0][4]].startswith("Permission")
    assert (got[3][3], got[3][4]) == (0, 19)
    assert L.scan(df.limit(0)).count() == 0 and L.scan(df, {}).count() == 0
