"""Row counts from the jobs that already run, and the size bound of CSV files."""

import uuid

import pytest
from pyspark.sql import functions as F

from verso.operators.counts import RowCounts
from verso.operators.model import fit_classifier, small_settings
from verso.operators.prepare import hash_split, prepare_rows, prepare_text_rows
from verso.plans import jobs
from verso.session import scratch_path
from verso.sources.csv import FileTooLargeError, read_songs_csv, write_songs_csv

SONG = "doc_id long, artist_name string, track_name string, release_date string, genre string, lyrics string"


def some_songs(spark, n=60):
    rows = [(i, f"a{i % 3}", f"t{i}", "1999", "en" if i % 2 else "de", f"the long text of song {i} of the list") for i in range(n)]
    rows += [(n, "a", "t", "1999", "en", "short"), (n + 1, "a", "t", "1999", "en", None), (n + 2, "a", "t", None, "en", "a text that is long enough"), (n + 3, "a", "t", "x", None, "a text that is long enough")]
    return spark.createDataFrame(rows, SONG)


def jobs_of(spark, work):
    """Number of Spark jobs that ``work`` starts."""
    sc, group = spark.sparkContext, f"counted-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_preparation_and_split_are_counted_by_the_fit(spark):
    counts = RowCounts()
    settings = small_settings(vocab_size=30, num_trees=2, max_depth=2, min_df=2.0)
    rows = some_songs(spark)

    def fit(counts):
        train, _ = hash_split(prepare_text_rows(rows, keep=("doc_id",), counts=counts), counts=counts)
        fit_classifier(train, settings)

    with_counts = jobs_of(spark, lambda: fit(counts))
    got = counts.get()
    prepared = prepare_text_rows(rows, keep=("doc_id",))
    train, test = hash_split(prepared)
    assert got == {
        "prepare.read": 64, "prepare.too_short": 2, "prepare.incomplete": 1, "prepare.prepared": 61,
        "split.train": train.count(), "split.test": test.count(),
    }
    assert with_counts == jobs_of(spark, lambda: fit(None))  # no job of its own


def test_null_year_is_incomplete(spark):
    counts = RowCounts()
    n = prepare_rows(some_songs(spark), counts=counts, step="five").count()
    assert counts.get() == {"five.read": 64, "five.too_short": 2, "five.incomplete": 2, "five.prepared": n} and n == 60


def test_empty_frame_counts_zero_and_idle_steps_are_an_error(spark):
    counts = RowCounts()
    assert prepare_rows(some_songs(spark).where("doc_id < 0"), counts=counts).count() == 0
    assert set(counts.get().values()) == {0}
    with pytest.raises(ValueError):
        counts.watch(some_songs(spark), "prepare", rows=F.lit(True))
    counts.watch(some_songs(spark), "never", rows=F.lit(True))
    with pytest.raises(RuntimeError, match="never"):
        counts.get(wait=1.0)


def test_corrupt_records_are_counted_by_the_read(spark):
    path = scratch_path(spark, "counted") + ".csv"
    lines = ["artist_name,track_name,release_date,genre,lyrics", "a,t,1999,en,one text", "a,t,1999,en,one,too many", "b,t,,de,\"two\nlines\""]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    counts = RowCounts()
    rows = jobs.read_corpus(spark, path, counts, "file")
    assert rows.count() == 2 and counts.get() == {"file.records": 3, "file.corrupt": 1}


def test_corpus_job_reports_its_rows(spark):
    rows = some_songs(spark, 8).select("doc_id", "artist_name", "track_name", F.col("doc_id").alias("popularity"), "genre", F.col("release_date").alias("song_date"), "lyrics")
    rows = rows.withColumn("track_name", F.when(F.col("doc_id") == 0, "a remix (Remix)").otherwise(F.concat("track_name", F.col("doc_id"))))
    counts = RowCounts()
    report = jobs.corpus_job(rows, None, scratch_path(spark, "counted-job"), counts=counts)
    got = counts.get()
    assert got["records.read"] == 12 and got["records.excluded"] == 1 and got["records.too_short"] == 2
    assert got["corpus.written"] == 9 == sum(r["songs"] for r in report.collect()) and got["corpus.without_year"] == 2


def test_the_format_can_be_told(spark):
    parquet, csv = scratch_path(spark, "looks-like") + "-csv", scratch_path(spark, "plain")
    rows = some_songs(spark, 5).drop("doc_id")
    rows.write.parquet(parquet)
    write_songs_csv(rows, csv)
    assert jobs.read_corpus(spark, parquet, fmt="parquet").count() == 9 == jobs.read_corpus(spark, csv, fmt="csv").count()
    with pytest.raises(ValueError):
        jobs.read_corpus(spark, csv, fmt="orc")


def test_large_csv_files_are_refused(spark):
    path = scratch_path(spark, "large-csv")
    write_songs_csv(some_songs(spark).drop("doc_id").coalesce(1), path)
    assert read_songs_csv(spark, path).count() == 64
    from verso.sources.csv import check_file_sizes, read_csv_text

    with pytest.raises(FileTooLargeError, match="bytes, more than 100"):
        read_csv_text(spark, path, max_file_bytes=100)
    check_file_sizes(spark, path, None)
