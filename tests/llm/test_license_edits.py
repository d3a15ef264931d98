"""The scan against the full alignment, on edited notices."""

import itertools
import random

from tests.llm.test_license_scan import full_align
from verso.llm import license_scan as L
from verso.llm.seeds import words


def test_scan_equals_full_alignment_on_edited_notices(spark):
    rnd = random.Random(8)
    texts = ["Released under MIT License", "Released under an MIT License", "Apache License, Ver 2.0", "Licensed under the Apache License, Ver 2.0."]
    for name, notice in L.TEMPLATES.items():
        ws = words(notice)
        if len(ws) < 16:
            for gone in itertools.combinations(range(len(ws)), 1 + (len(ws) > 9)):
                texts.append("see xx " + " ".join("qq" if i in gone else w for i, w in enumerate(ws)) + " end")
                texts.append(" ".join(w for i, w in enumerate(ws) if i not in gone))
            texts.append(" xx ".join(ws))
        for run in (9, 12, len(ws) // 2):  # inserted in the middle
            texts.append(" ".join(ws[: len(ws) // 2] + ["zz"] * run + ws[len(ws) // 2 :]))
        texts.append(" ".join(w for w in ws if rnd.random() > 0.18))
    texts.append(" ".join(rnd.choice(words(" ".join(L.TEMPLATES.values()))) for _ in range(400)))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {}
    for r in L.scan(rows).collect():
        got[(r.doc_id, r.license)] = max(r.matched_words, got.get((r.doc_id, r.license), 0))
    assert (0, "mit-line") in got and (1, "mit-line") in got
    checked = 0
    for d, t in enumerate(texts):
        for name, notice in L.TEMPLATES.items():
            ws, doc = words(notice), words(t)
            if len(set(ws) & set(doc)) < 0.5 * len(set(ws)):
                assert (d, name) not in got
                continue
            matched = full_align(ws, doc)[1]
            if matched >= 0.8 * len(ws):
                checked += 1
                assert got.get((d, name), 0) >= matched, (t, name)
    assert checked > 100
