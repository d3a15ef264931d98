import base64
import hashlib
import re

import numpy as np
import public_tokenizers as PT
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_pii_weak import brute_base, brute_secrets
from tests.llm.test_simhash_bk import brute_components, plain_simhash
from tests.llm.test_string_tiling import brute_leaks
from verso.llm import common, hd_langid
from verso.llm.seeds import words

SF = "/root/testdata/sf0.001"


def redacted(text):
    out, at = [], 0
    for s in sorted(brute_base(text) + brute_secrets(text), key=lambda s: int(s.split(":")[1])):
        k, a, b = s.split(":")
        if int(a) >= at:
            out += [text[at : int(a)], f"[{k.upper()}]"]
        at = max(at, int(b))
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def expected(spark):
    """Documents left and their texts, stage by stage, by brute force."""
    rows = [(r.doc_id, r.text, r.lang) for r in common.documents(spark, SF).collect()]
    model = hd_langid.Predictor(hd_langid.train(common.documents(spark, SF)))
    said, score = model([t or "" for _, t, _ in rows])
    rows = [r for r, s, x in zip(rows, said, score) if s != "und" and x >= hd_langid.MIN_SCORE]
    comps = brute_components([r[0] for r in rows], [plain_simhash(r[1]) for r in rows])
    rows = [r for r, c in zip(rows, comps) if r[0] == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + 5]) for _, t in items for w in [words(t)] for i in range(len(w) - 4)}
    near = [r for r in rows if any(tuple(w[i : i + 5]) in grams for w in [words(r[1])] for i in range(len(w) - 4))]
    bad = {d for d, *_ in brute_leaks([(d, t) for d, t, _ in near], items, 0.8, 5)}
    return {d: redacted(t) for d, t, _ in rows if d not in bad}, len(rows), bad


def test_run_equals_brute_force(spark, expected):
    want, before, bad = expected
    assert bad and len(want) == before - len(bad)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PT.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=PT.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, text in want.items():
        ids = enc.encode_ordinary(text)
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    rows = [(1, "the cat and the dog in the wood", "en", "s", 31, "x"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "x"), (4, "1234 !!", "en", "s", 7, "x"),
            (5, "le chat et le chien dans la forêt who@x.com", "fr", None, 30, "x"), (1, "the cat and the dog in the wood", "en", "s", 31, "x"), (None, "a lone dog and the cat", None, "s", 22, "x")]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.written(stage(spark, docs, SF), "t")
            assert docs.columns == df.columns
        if df.count():
            assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == [(1, rows[0][1]), (5, re.sub(r"\S+@\S+", "[EMAIL]", rows[4][1])), (None, rows[6][1])]
        assert "ids" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "personal_data", "tokens"]
