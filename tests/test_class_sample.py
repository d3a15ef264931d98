"""Bottom-k sample per class: brute force, any layout, ties, hot class."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from verso.operators.model import fit_classifier, small_settings
from verso.operators.prepare import HASH_BITS, bottom_k_thresholds, prepare_text_rows, sample_hash, sample_per_class
from verso.sources.tables import songs


def brute(rows, k):
    """Of each class the k smallest hashes; rows of one hash come whole or not at all."""
    out = []
    for g in {r["genre"] for r in rows}:
        own = sorted((r for r in rows if r["genre"] == g), key=lambda r: r["h"])
        limit = own[k]["h"] if len(own) > k else 1 << HASH_BITS
        out += [(r["genre"], r["h"]) for r in own if r["h"] < limit]
    return sorted(map(str, out))


@pytest.mark.parametrize("k", [0, 1, 7, 60, 10_000])
def test_brute_force_on_any_layout(spark, k):
    base = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("genre"),
        F.when(F.col("id") % 10 == 4, F.lit(4)).otherwise(F.col("id")).alias("doc_id"),  # one id on many rows
    ).withColumn("h", sample_hash("doc_id"))
    want = brute(base.collect(), k)
    for parts in (1, 13):
        got = sample_per_class(base.repartition(parts), k)
        assert got.columns == base.columns
        assert sorted(str((r["genre"], r["h"])) for r in got.collect()) == want


def test_border_deep_in_the_hash(spark, monkeypatch):
    """Hashes that agree in their first 36 bits: later digits decide."""
    rows = spark.range(200).select(F.lit("g").alias("genre"), F.col("id").alias("doc_id"))
    import verso.operators.prepare as P

    monkeypatch.setattr(P, "sample_hash", lambda c: (F.col(c) if isinstance(c, str) else c).cast("bigint") + (5 << 40))
    for k in (1, 64, 199):
        assert {r["doc_id"] for r in P.sample_per_class(rows, k).collect()} == set(range(k))


def test_empty_and_unlimited(spark):
    none = spark.createDataFrame([], "doc_id long, genre string")
    assert sample_per_class(none, 5).count() == 0 and bottom_k_thresholds(none, 5).count() == 0
    some = spark.createDataFrame([(1, "a")], none.schema)
    assert sample_per_class(some, None) is some


def test_only_counts_are_shuffled(spark):
    """Between the rows and the buckets is a partial aggregate: no exchange by class of rows."""
    rows = spark.range(1000).select(F.lit("g").alias("genre"), F.col("id").alias("doc_id"))
    plan = sample_per_class(rows, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("left_semi")[0] and "TakeOrdered" not in plan


def test_fit_on_a_sample(spark):
    rows = prepare_text_rows(songs(spark, SF_SMALL), keep=("doc_id",))
    settings = small_settings(vocab_size=80, num_trees=4, max_depth=3, min_df=2.0, max_rows_per_class=20)
    taken = sample_per_class(rows, 20)
    assert {r["genre"]: r["count"] for r in taken.groupBy("genre").count().collect()} == {r["genre"]: min(20, r["count"]) for r in rows.groupBy("genre").count().collect()}
    a, b = fit_classifier(rows.repartition(9), settings), fit_classifier(taken, small_settings(vocab_size=80, num_trees=4, max_depth=3, min_df=2.0))
    assert a.stages[-1].toDebugString.split("\n")[1:] == b.stages[-1].toDebugString.split("\n")[1:]
    assert a.stages[1].vocabulary == b.stages[1].vocabulary
