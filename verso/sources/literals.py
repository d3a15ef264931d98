"""Small literal frames for interactive scoring.

The reference builds a one-row frame per request with schema inference,
which fails when a column is null in every row; these helpers always pass
the declared schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from verso.functions.text import DEFAULT_YEAR
from verso.operators.score import score
from verso.schema import SONG_SCHEMA

TEXT_SCHEMA = T.StructType([T.StructField("lyrics", T.StringType(), True)])


def texts_frame(spark: SparkSession, texts: Iterable[str | None]) -> DataFrame:
    """One ``lyrics`` column."""
    return spark.createDataFrame([(t,) for t in texts], TEXT_SCHEMA)


def songs_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Rows of (artist_name, track_name, release_date, genre, lyrics)."""
    return spark.createDataFrame(list(rows), SONG_SCHEMA)


def predict_genre(
    spark: SparkSession, model: PipelineModel, text: str | None, release_year: int | None = None,
) -> DataFrame:
    """S6 + M12 + T15: score one text; the year defaults as in the
    reference (missing or zero -> 2000). Returns one scored row with the
    decoded label instead of an index message."""
    frame = songs_frame(spark, [(None, None, release_year or DEFAULT_YEAR, None, text)])
    return score(model, frame, keep=())
