"""The rejection of the pipeline's language stage (``keep_identified``)."""

from statistics import NormalDist

import numpy as np

import corpus_pipeline
from tests.llm.test_hd_langid import brute_vector
from verso.llm import common
from verso.llm import hd_langid as H

SF = "/root/testdata/sf0.01"
SHORT = ["A.", "A.\nAll rights reserved.", "Avec.", "Ok!", "Xyz", "Ζ", "zzzzzz zzzzzz " * 40]
GREEK = "Ο γρήγορος σκύλος κοιμάται κοντά στο ποτάμι και το παιδί διαβάζει ένα παλιό βιβλίο κάτω από το δέντρο. " * 3
THAI = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอนหรือวรรณยุกต์เช่นเดียวกับภาษาจีน " * 6


def brute_stays(text, prototypes, totals, dim):
    """The rule of the module's docstring, one n-gram at a time."""
    if not any(c.isalpha() for c in text):
        return False
    ((_, n),) = list(H.gram_counts([text], H.Space(dim)))
    noise, v = float(np.sqrt((n.astype(float) ** 2).sum())), brute_vector(text, dim)
    bound = NormalDist().inv_cdf(1 - H.CHANCE / len(prototypes))
    usual = min(np.linalg.norm(p) / totals[k] for k, p in prototypes.items())
    if H.SHARE * usual * n.sum() / noise < 2 * bound:
        return True
    return max(float(p @ v) / np.linalg.norm(p) for p in prototypes.values()) / noise >= bound


def test_short_clean_texts_stay_and_foreign_scripts_go(spark):
    docs = common.documents(spark, SF)
    prototypes, totals = H.train_with_totals(docs)
    assert all(np.array_equal(v, prototypes[k]) for k, v in H.train(docs).items())
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()] + SHORT + [GREEK, THAI, "", "12 34"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id for r in H.keep_identified(rows, prototypes, totals).collect()}
    assert got == {i for i, t in enumerate(texts) if brute_stays(t, prototypes, totals, H.DIM)}
    gone = {t for i, t in enumerate(texts) if i not in got}
    assert gone == {GREEK, THAI, "", "12 34"}


def test_unlike_texts_rarely_pass_and_own_texts_stay(spark):
    docs = common.documents(spark, SF)
    evidence = H.Evidence(*H.train_with_totals(docs))
    rnd = np.random.default_rng(5)
    letters = [chr(c) for c in range(0x10A0, 0x10C0)] + [chr(c) for c in range(0x0531, 0x0550)]  # Georgian, Armenian
    foreign = [" ".join("".join(rnd.choice(letters, rnd.integers(2, 9))) for _ in range(300)) for _ in range(200)]
    assert sum(evidence(foreign)) <= 3  # the fixed cosine let about a fifth of such texts pass
    assert all(evidence([r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")]))


def test_stage_keeps_every_text_with_letters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).select("doc_id").collect()}
    assert left == {r.doc_id for r in docs.filter(r"text rlike '\\p{L}'").select("doc_id").collect()}
