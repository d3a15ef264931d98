"""Fold features by subtraction: equal to separate fits, one pass over the texts."""

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.operators import features as feat
from verso.operators.model import fit_classifier, small_settings, tune
from verso.operators.prepare import hash_split, prepare_text_rows, with_fold
from verso.plans.training import evaluate
from verso.sources.tables import songs


@pytest.fixture(scope="module")
def tokens(spark):
    rows = with_fold(prepare_text_rows(songs(spark, SF_SMALL), keep=("doc_id",)), folds=3)
    return Tokenizer(inputCol="lyrics", outputCol="words").transform(rows).select("words", "fold").cache()


@pytest.mark.parametrize("min_df", [1.0, 2.0, 5.0, 0.02])
def test_every_union_of_folds_equals_a_separate_fit(spark, tokens, min_df):
    tfidf = feat.TfIdf(inputCol="words", outputCol="features", vocabSize=300, minDF=min_df)
    grouped = feat.GroupedTfIdf(tfidf, tokens, "fold", 3)
    for keep in ([0, 1], [1, 2], [0, 2], [2], [0, 1, 2]):
        part = tokens.where(F.col("fold").isin(keep))
        assert grouped.rows(keep) == part.count()
        for size in (300, 40):
            counts, weights = grouped.model(keep, size).stages
            alone = tfidf.copy({tfidf.vocabSize: size}).fit(part).stages
            assert counts.vocabulary == alone[0].vocabulary and len(counts.vocabulary) == size
            assert weights.getScalingVec() == alone[1].getScalingVec()


def test_larger_vocabulary_than_ranked_is_an_error(tokens):
    grouped = feat.GroupedTfIdf(feat.TfIdf(inputCol="words", vocabSize=10, minDF=1.0), tokens, "fold", 3)
    with pytest.raises(ValueError):
        grouped.model([0], 11)


def test_empty_group_and_empty_input(spark):
    none = spark.createDataFrame([], "words array<string>, fold int")
    some = spark.createDataFrame([(["a", "b", "a"], 2), (["b"], 2)], none.schema)
    grouped = feat.GroupedTfIdf(feat.TfIdf(inputCol="words", vocabSize=5, minDF=1.0), some, "fold", 3)
    assert grouped.rows([0, 1]) == 0 and grouped.model([2]).stages[0].vocabulary == ["a", "b"]
    assert feat.GroupedTfIdf(feat.TfIdf(inputCol="words", vocabSize=5, minDF=1.0), none, "fold", 3).stats.count() == 0


def test_group_sums_brute_force(spark, tokens):
    want = {}
    for r in tokens.collect():
        for i, w in enumerate([*r["words"], *set(r["words"])]):
            tf, df = want.setdefault(w, ([0] * 3, [0] * 3))
            (tf if i < len(r["words"]) else df)[r["fold"]] += 1
    got = {r["term"]: (r["tf"], r["df"]) for r in feat.term_stats_by_group(tokens, "fold", 3).collect()}
    assert got == want


def test_held_out_metrics_equal_a_separate_fit(spark):
    rows = prepare_text_rows(songs(spark, SF_SMALL), keep=("doc_id",))
    settings = small_settings(vocab_size=60, num_trees=4, max_depth=3, min_df=2.0)
    grid = dict(vocab_sizes=[60], num_trees=[4], max_depths=[3], num_folds=2)
    out = tune(rows, settings, hold_out=True, **grid)
    assert out.rows == rows.count()
    train, test = hash_split(rows)
    alone = evaluate(fit_classifier(train, settings), test).first()
    assert [round(x, 12) for x in out.metrics.first()] == [round(x, 12) for x in alone]
    whole = fit_classifier(rows, settings)
    assert whole.stages[-1].toDebugString.split("\n")[1:] == out.model.stages[-1].toDebugString.split("\n")[1:]


def test_a_class_only_in_held_out_rows(spark):
    rows = prepare_text_rows(songs(spark, SF_SMALL), keep=("doc_id",))
    odd = spark.range(10**6, 10**6 + 40).select(F.col("id").alias("doc_id"), F.lit("rare").alias("genre"), F.lit("la la la la la la").alias("lyrics"))
    only = hash_split(odd)[1]
    both = rows.unionByName(only)
    out = tune(both, small_settings(vocab_size=50, min_df=2.0), vocab_sizes=[50], num_trees=[3], max_depths=[3], num_folds=2, hold_out=True)
    assert out.metrics.first()["n"] == hash_split(both)[1].count()
