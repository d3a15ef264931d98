"""The three entry-point jobs end to end on the smallest tables."""

import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL, local_path
from verso.operators.model import small_settings
from verso.plans import jobs
from verso.plans.corpus import corpus_records_from_documents
from verso.schema import SONG_COLUMNS
from verso.__main__ import main as command
from verso.session import scratch_path
from verso.sources.models import load_model, model_labels
from verso.sources.csv import write_songs_csv
from verso.sources.tables import read_table, songs


def test_corpus_train_score_jobs(spark):
    out, out_csv = scratch_path(spark, "job-corpus"), scratch_path(spark, "job-corpus") + ".csv"
    docs = read_table(spark, SF_SMALL, "documents")
    report = jobs.corpus_job(corpus_records_from_documents(docs), read_table(spark, SF_SMALL, "pages"), out, out_csv)
    corpus = jobs.read_corpus(spark, out)
    assert corpus.count() == sum(r["songs"] for r in report.collect()) > 0
    assert jobs.read_corpus(spark, out_csv).count() == corpus.count()

    s = songs(spark, SF_SMALL).select(*SONG_COLUMNS)
    primary, secondary = scratch_path(spark, "job-primary"), scratch_path(spark, "job-secondary") + ".csv"
    s.where(F.col("genre") == "en").unionByName(s.where("genre = 'fr'")).write.parquet(primary)
    write_songs_csv(s.where(~F.col("genre").isin("en", "fr")), secondary)
    models = scratch_path(spark, "job-models")
    outcome = jobs.train_job(spark, primary, models, secondary, small_settings(vocab_size=100, num_trees=4, min_df=2.0),
                             vocab_sizes=[100], num_trees=[4], max_depths=[3], num_folds=2, with_year=False, hold_out=True)
    assert os.path.isdir(local_path(outcome.initial_model_path)) and os.path.isdir(local_path(outcome.merged_model_path))
    assert outcome.merged_metrics.first()["n"] > 0 and len(outcome.merged_cv_f1) == 1
    labels = model_labels(load_model(outcome.merged_model_path))
    assert sorted(labels) == ["de", "en", "es", "fr"]  # fitted on all rows of both

    landing = scratch_path(spark, "job-landing")
    docs.select("doc_id", F.col("text").alias("lyrics")).repartition(3).write.parquet(landing)
    batch_out, stream_out = scratch_path(spark, "job-scored"), scratch_path(spark, "job-streamed")
    jobs.score_job(spark, outcome.merged_model_path, landing, batch_out, ("doc_id",))
    jobs.score_job(spark, outcome.merged_model_path, landing, stream_out, ("doc_id",), stream=True, max_files_per_trigger=1)
    a = spark.read.parquet(batch_out).select("doc_id", "predicted_label").collect()
    b = spark.read.parquet(stream_out).select("doc_id", "predicted_label").collect()
    assert len(a) == docs.count() and sorted(a) == sorted(b)
    with pytest.raises(ValueError):
        jobs.score_job(spark, outcome.merged_model_path, landing, batch_out, ())


def test_command_line_limits(spark, capsys):
    out = scratch_path(spark, "cli-corpus")
    docs, pages = f"{SF_SMALL}/documents.parquet", f"{SF_SMALL}/pages.parquet"
    command(["corpus", "--documents", docs, "--pages", pages, "--output", out, "--per-artist", "all", "--target", "all"])
    every = spark.read.parquet(out).count()
    command(["corpus", "--documents", docs, "--output", out, "--per-artist", "2", "--target", "5", "--artists", "src3", "src1", "src2"])
    kept = {r["artist_name"]: r["n"] for r in spark.read.parquet(out).groupBy("artist_name").agg(F.count("*").alias("n")).collect()}
    assert kept == {"src3": 2, "src1": 2, "src2": 2} and every > 150
    assert "src3\t2" in capsys.readouterr().out


def test_stream_carries_rejected_rows(spark):
    from pyspark.sql import types as T

    from verso.operators.prepare import prepare_text_rows
    from verso.operators.model import fit_classifier
    from verso.streaming.score_stream import run_score_stream

    rows = prepare_text_rows(songs(spark, SF_SMALL), keep=("doc_id",))
    model = fit_classifier(rows, small_settings(vocab_size=80, num_trees=3, max_depth=3, min_df=2.0))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lyrics", T.StringType())])
    landing = scratch_path(spark, "job-landing-rejects")
    spark.createDataFrame([(1, None), (2, "short"), (3, "the the and of the and to be")], schema).write.parquet(landing)
    out = {r["doc_id"]: r for r in spark.read.parquet(run_score_stream(spark, model, landing, schema)).collect()}
    assert out[1]["error"] and out[2]["error"] and out[1]["predicted_label"] is None
    assert out[3]["error"] is None and out[3]["predicted_label"] is not None


def test_corpus_job_with_no_rows(spark):
    docs = read_table(spark, SF_SMALL, "documents").where(F.lit(False))
    out_csv = scratch_path(spark, "job-empty-corpus-csv")
    report = jobs.corpus_job(corpus_records_from_documents(docs), None, scratch_path(spark, "job-empty-corpus"), out_csv)
    assert report.count() == 0 and not os.path.exists(local_path(out_csv))
