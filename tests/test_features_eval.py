"""Features and metrics, cross-checked against MLlib's own estimators."""

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer, Tokenizer
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.operators import features as feat
from verso.operators.evaluate import classification_metrics, confusion_counts, metrics_report


@pytest.fixture(scope="module")
def tokens(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.col("text").alias("lyrics"))
    return Tokenizer(inputCol="lyrics", outputCol="words").transform(docs).cache()


def test_tokenizer_semantics(spark):
    df = spark.createDataFrame([(" A  b\tC d ",)], "lyrics string")
    words = Tokenizer(inputCol="lyrics", outputCol="w").transform(df).collect()[0]["w"]
    # leading and inner empty tokens stay, trailing ones go; no-break space does not split
    assert words == ["", "a", "", "b", "c d"]


def test_term_stats_brute_force(spark, tokens):
    got = {r["term"]: (r["tf"], r["df"]) for r in feat.term_stats(tokens).collect()}
    tf, df = {}, {}
    for r in tokens.select("words").collect():
        for w in r["words"]:
            tf[w] = tf.get(w, 0) + 1
        for w in set(r["words"]):
            df[w] = df.get(w, 0) + 1
    assert got == {w: (tf[w], df[w]) for w in tf}


def test_row_counts_brute_force(spark, tokens):
    from collections import Counter

    odd = spark.createDataFrame([(-1, []), (-2, ["", "", "b"])], "doc_id long, words array<string>")
    both = tokens.select("doc_id", "words").unionByName(odd)
    want = {(r["doc_id"], w, n) for r in both.collect() for w, n in Counter(r["words"]).items()}
    rows = feat.exploded_counts(feat.row_term_counts(both))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(want) and set(got) == want


def test_vocabulary_does_not_depend_on_the_fan_in(spark, tokens):
    stats = feat.term_stats(tokens).cache()
    lists = [[tuple(r) for r in feat.vocabulary(stats, 200, 2.0, fan_in=n).orderBy("index").collect()] for n in (1, 3, 16)]
    assert lists[0] == lists[1] == lists[2]
    brute = sorted(((r["term"], r["tf"], r["df"]) for r in stats.collect() if r["df"] >= 2), key=lambda r: (-r[1], r[0]))[:200]
    assert [x[:3] for x in lists[0]] == brute


def test_vocabulary_equals_countvectorizer_set(spark, tokens):
    vocab = [r["term"] for r in feat.vocabulary(feat.term_stats(tokens), 500, 5.0).orderBy("index").collect()]
    cv = CountVectorizer(inputCol="words", outputCol="raw", vocabSize=500, minDF=5.0).fit(tokens)
    stats = {r["term"]: r["tf"] for r in feat.term_stats(tokens).collect()}
    # Same terms except where MLlib cut a tie at the boundary differently.
    boundary = stats[vocab[-1]]
    ours = {t for t in vocab if stats[t] != boundary}
    theirs = {t for t in cv.vocabulary if stats[t] != boundary}
    assert ours == theirs
    assert [stats[t] for t in vocab] == sorted((stats[t] for t in vocab), reverse=True)


def test_tfidf_equals_countvectorizer_plus_idf(spark, tokens):
    model = feat.TfIdf(inputCol="words", outputCol="features", vocabSize=300, minDF=5.0).fit(tokens)
    counts = model.stages[0]
    idf = IDF(inputCol="rawFeatures", outputCol="native").fit(counts.transform(tokens))
    out = idf.transform(model.transform(tokens)).select("features", "native").collect()
    for r in out:
        a, b = r["features"].toArray(), r["native"].toArray()
        assert max(abs(x - y) for x, y in zip(a, b)) < 1e-12


def test_label_index_equals_string_indexer(spark):
    df = spark.createDataFrame([(g,) for g in "b a c a b d b a".split()], "genre string")
    ours = [r["genre"] for r in feat.label_index(df).orderBy("label").collect()]
    native = StringIndexer(inputCol="genre", outputCol="label").fit(df).labels
    assert ours == list(native) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_equal_mllib_evaluator(spark, seed):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 3)), float(rnd.choice([0, 1, 2, 3, 4]))) for _ in range(300)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    ours = classification_metrics(pred).collect()[0]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in [("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")]:
        assert abs(ours[name] - ev.setMetricName(metric).evaluate(pred)) < 1e-12, name
    assert ours["n"] == 300


def test_confusion_and_report(spark):
    pred = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    cc = {(r["label"], r["prediction"]): r["n"] for r in confusion_counts(pred).collect()}
    assert cc == {(0.0, 0.0): 1, (0.0, 1.0): 1, (1.0, 1.0): 2}
    rep = {r["metric"]: r["value"] for r in metrics_report(classification_metrics(pred)).collect()}
    assert set(rep) == {"Accuracy", "Precision", "Recall", "F1"} and rep["Accuracy"] == 0.75


def test_vocabulary_estimator_is_repeatable_countvectorizer(spark, tokens):
    model = feat.Vocabulary(inputCol="words", outputCol="raw", vocabSize=200, minDF=3.0).fit(tokens)
    expect = [r["term"] for r in feat.vocabulary(feat.term_stats(tokens), 200, 3.0).orderBy("index").collect()]
    assert list(model.vocabulary) == expect
    again = feat.Vocabulary(inputCol="words", outputCol="raw", vocabSize=200, minDF=3.0).fit(tokens.repartition(5))
    assert list(again.vocabulary) == expect


def test_fractional_min_df_matches_countvectorizer(spark, tokens):
    ours = feat.Vocabulary(inputCol="words", outputCol="raw", vocabSize=100000, minDF=0.05).fit(tokens)
    native = CountVectorizer(inputCol="words", outputCol="raw", vocabSize=100000, minDF=0.05).fit(tokens)
    assert set(ours.vocabulary) == set(native.vocabulary) and len(ours.vocabulary) > 10
