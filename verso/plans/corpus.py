"""Build the corpus in the collector's order.

artist list (filter and order) -> exclude titles (P6) -> top k per artist by
popularity (W1) -> optional search look-up (J1) -> raw length test (P8) -> dedup on
artist + title, most popular first (A4) -> cap at artist boundary (W2) -> year with
detail fallback (J2 + T7) -> clean (T1-T6).

The per-artist limit comes before the length test and the dedup, as in the
reference, so an artist may end with fewer than k songs, and the cap counts
kept songs only.

Narrow first: everything up to the cap runs on (id, artist, title key,
popularity, long enough, artist rank). Texts are read in the scan but never
shuffled before the winners are known; the kept songs are checkpointed once, and
counts, cap and totals come from that table. Years and cleaning then run on the
winners' rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verso.functions.text import RAW_MIN_CHARS, clean_lyrics, first_year, has_min_chars
from verso.operators.corpus import (
    SONGS_PER_ARTIST,
    TARGET_SONGS,
    best_hits,
    cap_at_target,
    count_per_group,
    dedup_first,
    text_key,
    top_per_group,
)
from verso.operators.counts import RowCounts
from verso.operators.filters import title_excluded
from verso.schema import SONG_COLUMNS
from verso.session import materialize
from verso.sources.tables import page_years


def kept_songs(
    records: DataFrame, order_col: str = "doc_id", popularity_col: str = "popularity",
    top_k: int | None = SONGS_PER_ARTIST, target: int | None = TARGET_SONGS, exclude: bool = True,
    hits: DataFrame | None = None, artists: Sequence[str] | None = None, counts: RowCounts | None = None,
) -> DataFrame:
    """The songs that the collector keeps, as (id, artist_name, hit_id), narrow and
    checkpointed; ``hit_id`` is the id whose text counts (the song's own id if no
    ``hits`` are given). See ``build_corpus`` for the arguments."""
    rank = F.lit(None).cast("int")
    if artists is not None:
        # The configured list is filter and order: a handful of names in the plan.
        rank = F.array_position(F.array(*map(F.lit, artists)), F.col("artist_name")).cast("int")
    narrow = records.select(
        F.col(order_col).alias("_id"), "artist_name", text_key("track_name").alias("_title"),
        F.col(popularity_col).alias("_popularity"), has_min_chars("lyrics", RAW_MIN_CHARS).alias("_long"), rank.alias("_rank_of_artist"),
        (title_excluded() if exclude else F.lit(False)).alias("_excluded"),
    )
    if counts is not None:
        short = ~F.col("_excluded") & ~F.col("_long")
        narrow = counts.watch(narrow, "records", read=F.lit(True), excluded=F.col("_excluded"), too_short=short)
    narrow = narrow.where(~F.col("_excluded"))
    if artists is not None:
        narrow = narrow.where(F.col("artist_name").isin(list(artists)))
    if top_k is not None:
        narrow = top_per_group(narrow, ["artist_name"], [F.desc("_popularity"), F.asc("_id")], top_k)
    if hits is None:
        narrow = narrow.withColumn("hit_id", F.col("_id"))
    else:
        # What counts from here on is the hit's title and lyrics.
        own = hits.select("hit_id", text_key("track_name").alias("_hit_title"), has_min_chars("lyrics", RAW_MIN_CHARS).alias("_hit_long"))
        narrow = narrow.join(best_hits(hits), ["artist_name", "_title"]).join(own, "hit_id").withColumn("_title", F.col("_hit_title")).withColumn("_long", F.col("_hit_long"))
    narrow = narrow.where("_long").select("_id", "hit_id", "artist_name", "_title", "_popularity", "_rank_of_artist")
    # An artist's songs come most popular first; the first copy of a title stays.
    first = F.struct((-F.col("_popularity")).alias("p"), F.col("_id").alias("i"))
    kept = materialize(dedup_first(narrow, ("artist_name", "_title"), first))
    order = "_rank_of_artist" if artists is not None else None
    return cap_at_target(kept, "artist_name", order, target).select(F.col("_id").alias(order_col), "artist_name", "hit_id")


def build_corpus(
    records: DataFrame, details: DataFrame | None = None, order_col: str = "doc_id",
    popularity_col: str = "popularity", top_k: int | None = SONGS_PER_ARTIST, target: int | None = TARGET_SONGS,
    exclude: bool = True, hits: DataFrame | None = None, artists: Sequence[str] | None = None, counts: RowCounts | None = None,
) -> DataFrame:
    """``records``: order_col (unique), artist_name, track_name, popularity_col
    (not null), genre, lyrics (raw), and either song_date (text holding the song's
    date, may be null; the year is its first 4-digit run, else the detail
    year) or release_year (already resolved, e.g. from a payload).
    ``details``: detail records (page_id, html) that hold the fallback year.
    ``hits``: optional look-up (hit_id, artist_name, track_name, lyrics); each
    song is searched by title and artist after the per-artist limit, songs
    without a hit are skipped, and a hit's own title, lyrics and detail record
    are used (J1).
    ``artists``: optional list; only these artists, taken in this order (else all,
    by name). ``top_k`` and ``target``: None for no limit.
    ``counts``: gets the records read, excluded by title and (of the rest) too short, from
    the scan that makes the narrow rows.
    Returns order_col plus the five song columns, lyrics cleaned."""
    # At most target + top_k rows are kept if both are given; Spark picks the
    # join from the sizes it measures.
    kept = materialize(kept_songs(records, order_col, popularity_col, top_k, target, exclude, hits, artists, counts))
    dated = "song_date" in records.columns
    own = ["track_name", "lyrics"] if hits is None else []
    rows = records.select(order_col, "artist_name", "genre", "song_date" if dated else "release_year", *own)
    rows = rows.join(kept.select(order_col, "hit_id"), order_col)
    if hits is not None:
        rows = rows.join(hits.select("hit_id", "track_name", "lyrics"), "hit_id")
    if dated and details is not None:
        wanted = details.join(kept.select(F.col("hit_id").alias("page_id")), "page_id", "left_semi")
        rows = rows.join(page_years(wanted), F.col("hit_id") == F.col("_detail_id"), "left")
        year = F.coalesce(first_year("song_date"), F.col("_detail_year"))
    else:
        year = first_year("song_date") if dated else F.col("release_year")
    return rows.select(
        order_col, "artist_name", "track_name", year.try_cast("int").alias("release_date"), "genre", clean_lyrics("lyrics").alias("lyrics"),
    ).select(order_col, *SONG_COLUMNS)


def corpus_records_from_documents(documents: DataFrame) -> DataFrame:
    """Stand-in collector input: source as artist, n_chars as popularity,
    the text as title, song date and lyrics, lang as genre."""
    return documents.select(
        "doc_id",
        F.col("source").alias("artist_name"),
        F.col("text").alias("track_name"),
        F.col("n_chars").alias("popularity"),
        F.col("text").alias("song_date"),
        F.col("lang").alias("genre"),
        F.col("text").alias("lyrics"),
    )


def corpus_from_documents(documents: DataFrame, pages: DataFrame | None = None, **kwargs) -> DataFrame:
    return build_corpus(corpus_records_from_documents(documents), pages, **kwargs)


def corpus_report(corpus: DataFrame) -> DataFrame:
    """A1: songs per artist over the final corpus."""
    return count_per_group(corpus, "artist_name", "songs")
