"""Row filters and projections of the collection and training steps
(P6-P9, P11-P14)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.functions.text import (
    DEFAULT_GENRE,
    DEFAULT_YEAR,
    RAW_MIN_CHARS,
    default_year,
    has_min_chars,
    title_exclusion_pattern,
)
from verso.schema import SONG_COLUMNS


def title_excluded(title_col: str = "track_name", terms: Iterable[str] | None = None, literal: bool = False) -> Column:
    """Whether a title matches an excluded term (case-insensitive search); no for null."""
    return F.coalesce(F.col(title_col).rlike(title_exclusion_pattern(terms, literal)), F.lit(False))


def exclude_titles(
    df: DataFrame, title_col: str = "track_name", terms: Iterable[str] | None = None,
    literal: bool = False,
) -> DataFrame:
    """Drop records whose title matches an excluded term (case-insensitive
    search). A null title is kept."""
    return df.where(~title_excluded(title_col, terms, literal))


def filter_record_kind(df: DataFrame, kind_col: str, keep: Iterable[str]) -> DataFrame:
    """Keep only records of the wanted kind (drop non-songs)."""
    return df.where(F.col(kind_col).isin(list(keep)))


def collect_filter(df: DataFrame, text_col: str = "lyrics", min_chars: int = RAW_MIN_CHARS) -> DataFrame:
    """Skip records whose raw text is null, empty or shorter than
    ``min_chars``; tested before cleaning."""
    return df.where(has_min_chars(text_col, min_chars))


def tag_constant_label(df: DataFrame, genre: str = DEFAULT_GENRE, col: str = "genre") -> DataFrame:
    """Every record of one collection run carries the same label."""
    return df.withColumn(col, F.lit(genre))


def to_song_schema(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Project to the five song columns (plus ``keep``), in order."""
    return df.select(*keep, *SONG_COLUMNS)


def with_default_year(df: DataFrame, col: str = "release_date", default: int = DEFAULT_YEAR) -> DataFrame:
    """A missing or zero year becomes ``default``."""
    return df.withColumn(col, default_year(col, default))
