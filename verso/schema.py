"""Declared schemas: the song record and the raw API payload."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and order of the song table.
SONG_COLUMNS = ["artist_name", "track_name", "release_date", "genre", "lyrics"]

SONG_SCHEMA = T.StructType(
    [
        T.StructField("artist_name", T.StringType(), True),
        T.StructField("track_name", T.StringType(), True),
        T.StructField("release_date", T.IntegerType(), True),
        T.StructField("genre", T.StringType(), True),
        T.StructField("lyrics", T.StringType(), True),
    ]
)

# Raw API payload: every level may be missing.
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("artist", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField(
            "song",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("title", T.StringType()),
                    T.StructField("lyrics", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "detail",
            T.StructType(
                [
                    T.StructField(
                        "song",
                        T.StructType(
                            [
                                T.StructField("release_date", T.StringType()),
                                T.StructField(
                                    "album",
                                    T.StructType(
                                        [T.StructField("release_date", T.StringType())]
                                    ),
                                ),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)


class MissingColumnsError(ValueError):
    """Raised when a frame lacks columns a step needs."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """S3: reject a frame that lacks any of ``required`` (checked on the driver,
    from the schema only; no job runs)."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df
