"""Landed API payloads (S7, T11): JSON text -> song record fields.

Each payload row holds one song with optional nested detail:
``{"artist": {"name"}, "song": {"id", "title", "lyrics"},
   "detail": {"song": {"release_date", "album": {"release_date"}}}}``.
Any level may be missing; malformed JSON parses to nulls (PERMISSIVE), so
the row stays with a null year instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.functions.text import DEFAULT_GENRE, year_with_fallback
from verso.schema import PAYLOAD_SCHEMA


def parse_payload(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, PAYLOAD_SCHEMA, {"mode": "PERMISSIVE"})


def payload_records(df: DataFrame, json_col: str = "payload", keep=()) -> DataFrame:
    """One song record per payload row.

    ``detail`` is the song-detail lookup already joined in (J2); a missing
    detail just leaves the year null.
    """
    p = parse_payload(json_col)
    return df.select(
        *keep,
        p.getField("song").getField("id").alias("song_id"),
        p.getField("artist").getField("name").alias("artist_name"),
        p.getField("song").getField("title").alias("track_name"),
        year_with_fallback(
            p.getField("detail").getField("song").getField("release_date"),
            p.getField("detail").getField("song").getField("album").getField("release_date"),
        ).alias("release_year"),
        p.getField("song").getField("lyrics").alias("lyrics"),
    )


def corpus_records_from_payloads(
    df: DataFrame, json_col: str = "payload", id_col: str = "doc_id", popularity_col: str = "popularity",
    genre: str = DEFAULT_GENRE,
) -> DataFrame:
    """Collector input from landed payloads: the record fields, the year
    already resolved inside the payload (song date, else album date), and
    the run's constant label (P11)."""
    recs = payload_records(df, json_col, keep=(id_col, popularity_col))
    return recs.select(
        id_col, "artist_name", "track_name", popularity_col, "release_year",
        F.lit(genre).alias("genre"), "lyrics",
    )
