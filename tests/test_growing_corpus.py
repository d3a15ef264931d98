"""Appends across runs: equal to one dedup over all, failed tries, no move of the old side."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.operators.corpus import dedup_first
from verso.operators.growing_corpus import GrowingCorpus, song_key
from verso.session import scratch_path

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("artist_name", "track_name", "lyrics")]])


def rows_of(spark, ids):
    """Ten artists (one with a third of the rows, one null), titles that come again."""
    i = F.col("id")
    artist = F.when(i % 3 == 0, F.lit("hot")).when(i % 10 != 7, F.concat(F.lit("a"), (i % 10).cast("string")))
    title = F.when(i % 11 != 5, F.concat(F.lit("t"), (i % 97).cast("string")))
    return spark.createDataFrame([(x,) for x in ids], "id long").select(i.alias("doc_id"), artist.alias("artist_name"), title.alias("track_name"), F.concat(F.lit("l"), i.cast("string")).alias("lyrics"))


def ids(df):
    return sorted((r["doc_id"], r["run"]) for r in df.select("doc_id", "run").collect())


def brute(parts):
    have, out = set(), []
    for run, rows in enumerate(parts):
        for r in sorted(rows, key=lambda r: r["doc_id"]):
            if (r["artist_name"], r["track_name"]) not in have:
                have.add((r["artist_name"], r["track_name"]))
                out.append((r["doc_id"], run))
    return sorted(out)


def test_two_appends_equal_one_dedup(spark):
    parts = [rows_of(spark, range(0, 900)), rows_of(spark, range(700, 2000)), rows_of(spark, [])]
    corpus = GrowingCorpus(spark, scratch_path(spark, "corpus"), SCHEMA, buckets=5)
    assert corpus.songs().count() == 0
    n = [corpus.append(p, run) for run, p in enumerate(parts)]
    want = brute([p.collect() for p in parts])
    assert ids(corpus.songs()) == want and sum(n) == len(want) and n[2] == 0
    whole = dedup_first(parts[0].unionByName(parts[1]).dropDuplicates(["doc_id"]), ("artist_name", "track_name"), "doc_id")
    assert sorted(r["doc_id"] for r in whole.collect()) == [d for d, _ in want]
    # a finished run adds nothing
    assert corpus.append(parts[1], 1) == n[1] and ids(corpus.songs()) == want


@pytest.mark.parametrize("step", ["songs", "keys", "runs"])
def test_failed_try(spark, step):
    folder = scratch_path(spark, "corpus")
    parts = [rows_of(spark, range(300)), rows_of(spark, range(200, 700))]
    corpus = GrowingCorpus(spark, folder, SCHEMA, buckets=3)
    corpus.append(parts[0], 0)

    def fail(name):
        if name == step:
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        corpus.append(rows_of(spark, range(650, 800)) if step != "runs" else parts[1], 1, after=fail)
    again = GrowingCorpus(spark, folder, SCHEMA, buckets=3)
    assert len(ids(again.songs())) == len(brute([parts[0].collect()])) or step == "runs"
    again.append(parts[1], 1)
    assert ids(again.songs()) == brute([p.collect() for p in parts])


@pytest.mark.parametrize("buckets", [3, 8, 12])  # fewer, as many and more than shuffle partitions
def test_the_old_side_is_not_shuffled(spark, buckets):
    corpus = GrowingCorpus(spark, scratch_path(spark, "corpus"), SCHEMA, buckets=buckets)
    corpus.append(rows_of(spark, range(500)), 0)
    # AQE off: the plan as it is before any run-time change
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = corpus.new_rows(rows_of(spark, range(400, 900)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "corpus_keys" in x)
    assert "Bucketed: true" in lines[scan]
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    up, at = [], depth(lines[scan])
    for x in reversed(lines[:scan]):  # the operators from the key scan up to the join
        if depth(x) < at:
            up.append(x)
            at = depth(x)
        if "SortMergeJoin" in x:
            break
    assert "SortMergeJoin" in up[-1] and not any("Exchange" in x for x in up)
    assert plan.count("Exchange hashpartitioning(_key") <= 2  # the new side's: dedup and deal


def test_key_tells_apart(spark):
    pairs = [("a", "bc"), ("ab", "c"), (None, "x"), ("-", "x"), ("x", None), ("x", "-"), (None, None), ("", ""), ("+", "a"), ("a:b", "c"), ("a", "b:c")]
    keys = spark.createDataFrame(pairs, "artist_name string, track_name string").select(song_key().alias("k")).collect()
    assert len({r["k"] for r in keys}) == len(pairs)
