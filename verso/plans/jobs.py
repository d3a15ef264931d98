"""The reference's three entry points as Spark jobs.

* ``corpus_job``: landed song records -> corpus table + songs per artist.
* ``train_job``: corpora -> prepared rows -> split -> fit -> metrics ->
  saved model; then both corpora merged -> tuned -> saved merged model.
* ``score_job``: saved model + texts (table or stream) -> scored rows.

All paths are shared-storage folders; every step is a DataFrame job. Tables
are handed on as parquet; CSV (one task a file) is for import and export.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.operators.counts import RowCounts
from verso.operators.model import ForestSettings, GRID_MAX_DEPTHS, GRID_NUM_TREES, GRID_VOCAB_SIZES
from verso.operators.score import score
from verso.plans.corpus import build_corpus, corpus_report
from verso.plans.training import train_and_evaluate, train_merged
from verso.schema import SONG_COLUMNS, require_columns
from verso.sources.csv import read_songs_csv, write_songs_csv
from verso.sources.model_store import load_version, save_version, version_path, versions
from verso.sources.models import load_model
from verso.streaming.score_stream import start_score_stream


def corpus_job(records: DataFrame, details: DataFrame | None, out_path: str, csv_path: str | None = None, counts: RowCounts | None = None, **kwargs) -> DataFrame:
    """C1 + S4: build the corpus once, write it as parquet (and, if asked for, as
    CSV: nothing for no rows) and return the songs-per-artist report (A1), read
    from the written table. ``counts`` gets the steps ``records`` and ``corpus``."""
    corpus = build_corpus(records, details, counts=counts, **kwargs)
    if counts is not None:
        corpus = counts.watch(corpus, "corpus", written=F.lit(True), without_year=F.col("release_date").isNull())
    corpus.write.mode("overwrite").parquet(out_path)
    corpus = records.sparkSession.read.parquet(out_path)
    if csv_path is not None:
        write_songs_csv(corpus.select(*SONG_COLUMNS), csv_path)
    return corpus_report(corpus)


def read_corpus(spark: SparkSession, path: str, counts: RowCounts | None = None, step: str = "file", fmt: str | None = None) -> DataFrame:
    """A song table in ``fmt`` ("csv" or "parquet"; None: a CSV file or folder if the path
    says so, else parquet). ``counts`` gets the records of a CSV and how many of them do
    not fit its header."""
    if fmt not in (None, "csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    if fmt == "csv" or (fmt is None and path.rstrip("/").lower().endswith((".csv", "-csv", "_csv"))):
        return read_songs_csv(spark, path, counts=counts, step=step)
    return require_columns(spark.read.parquet(path), SONG_COLUMNS)


def with_row_id(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A stable row id for corpora that carry none: a hash of the record's own
    fields, so the split does not depend on file layout."""
    if id_col in df.columns:
        return df
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]
    return df.withColumn(id_col, F.xxhash64(*fields))


@dataclass
class TrainOutcome:
    initial_model_path: str
    initial_metrics: DataFrame
    merged_model_path: str | None
    merged_metrics: DataFrame | None
    merged_cv_f1: list[float]
    counts: dict[str, int]  # rows of each step, from the jobs above


def _published(spark: SparkSession, model, store: str) -> str:
    """The model as a new version of its store; the folder of that version. Versions that
    a scoring job may be reading stay."""
    return version_path(spark, store, save_version(model, store))


def train_job(
    spark: SparkSession, primary_path: str, model_dir: str, secondary_path: str | None = None,
    settings: ForestSettings = ForestSettings(), vocab_sizes=GRID_VOCAB_SIZES, num_trees=GRID_NUM_TREES,
    max_depths=GRID_MAX_DEPTHS, num_folds: int = 3, with_year: bool = True, hold_out: bool = False,
    fmt: str | None = None,
) -> TrainOutcome:
    """The trainer's main flow on two corpora (parquet or CSV folders).

    ``with_year`` keeps the reference's five-column preparation (rows
    without a year are dropped); ``False`` trains on every text. The merged
    model is fitted on all rows; ``hold_out`` measures it by a second fit. ``fmt``: the
    corpora's format (``read_corpus``).
    """
    counts = RowCounts()
    primary = with_row_id(read_corpus(spark, primary_path, counts, "primary_file", fmt))
    first = train_and_evaluate(primary, settings, with_year=with_year, counts=counts)
    initial_path = _published(spark, first.model, f"{model_dir.rstrip('/')}/initial_model")
    if secondary_path is None:
        return TrainOutcome(initial_path, first.metrics, None, None, [], counts.get())
    secondary = with_row_id(read_corpus(spark, secondary_path, counts, "secondary_file", fmt))
    merged = train_merged(
        primary, secondary, settings, with_year=with_year, hold_out=hold_out, counts=counts, vocab_sizes=vocab_sizes,
        num_trees=num_trees, max_depths=max_depths, num_folds=num_folds,
    )
    merged_path = _published(spark, merged.model, f"{model_dir.rstrip('/')}/merged_model")
    return TrainOutcome(initial_path, first.metrics, merged_path, merged.metrics, merged.cv_f1, counts.get())


def score_job(
    spark: SparkSession, model_path: str, input_path: str, output_path: str, keep: tuple[str, ...],
    text_col: str = "lyrics", stream: bool = False, input_schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Score a parquet folder; as a batch job (returns nothing,
    writes parquet) or as an available-now stream with its checkpoint
    beside the output. ``keep`` names the columns that tie a prediction to its
    row; at least one is needed. ``model_path``: a model's folder, or a store of versions;
    then the latest is loaded, once, and used to the end."""
    if not keep:
        raise ValueError("keep needs a column that identifies a row")
    model = load_version(spark, model_path) if versions(spark, model_path) else load_model(model_path)
    if stream:
        schema = input_schema or spark.read.parquet(input_path).schema
        q = start_score_stream(spark, model, input_path, schema, output_path,
                               f"{output_path.rstrip('/')}_checkpoint", text_col, keep, True, max_files_per_trigger)
        q.awaitTermination()
        return
    rows = require_columns(spark.read.parquet(input_path), keep)
    score(model, rows, text_col=text_col, keep=keep).write.mode("overwrite").parquet(output_path)
