"""Corpus operators: look-ups, top-k per group, dedup, cap, counts, union
(J1, J2, W1, A1-A4, W2, U1).

Skew notes (one artist or one title may hold a third of all rows):

* top-k uses ``row_number() <= k``; Spark adds a partial group limit before
  the shuffle, so a hot group sends at most k narrow rows per map task.
* dedup is a ``min_by`` aggregate, which is partially aggregated map-side:
  a hot key sends one row per map task.
* the cap counts per group (partial aggregate) and never sees songs in one
  task; see ``prefix.exclusive_prefix_sum``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verso.operators.prefix import exclusive_prefix_sum
from verso.schema import SONG_COLUMNS

# Collection settings of the reference.
TARGET_SONGS = 100
SONGS_PER_ARTIST = 10


def text_key(c: Column | str) -> Column:
    """A title as a short key: SHA-256 of the whole text (null stays null)."""
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


def matched_records(songs: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Songs that have a search hit (inner on the keys; misses skipped).

    ``hits`` is reduced to its distinct keys first, so a key repeated in
    ``hits`` neither multiplies songs nor skews the join.
    """
    return songs.join(hits.select(*keys).distinct(), list(keys), "left_semi")


def unmatched_records(songs: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Songs without a hit (the ones the reference skips). Hits are
    reduced to distinct keys first (partial aggregate), so a key repeated
    across many hits does not land in one task."""
    return songs.join(hits.select(*keys).distinct(), list(keys), "left_anti")


def best_hits(hits: DataFrame, hit_id: str = "hit_id") -> DataFrame:
    """(artist_name, _title, hit_id): of several hits for an artist and a title the
    smallest id (partial aggregate, so a hot key sends one row per map task)."""
    keyed = hits.select(hit_id, "artist_name", text_key("track_name").alias("_title"))
    return keyed.groupBy("artist_name", "_title").agg(F.min(hit_id).alias(hit_id))


def search_hits(songs: DataFrame, hits: DataFrame, id_col: str = "doc_id", hit_id: str = "hit_id") -> DataFrame:
    """J1 as the collector does it: each song is looked up by title and artist,
    and the hit's own id is what the collector goes on with (its title, lyrics
    and detail record). ``songs`` and ``hits`` have artist_name and track_name.
    Returns (id_col, hit_id); songs without a hit are skipped. Titles meet as
    keys, so no text is shuffled."""
    keyed = songs.select(id_col, "artist_name", text_key("track_name").alias("_title"))
    return keyed.join(best_hits(hits, hit_id), ["artist_name", "_title"]).select(id_col, hit_id)


def top_per_group(
    df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int = SONGS_PER_ARTIST,
    rank_col: str | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``.

    ``order`` should end in a unique column so ties are repeatable.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", rank_col) if rank_col else ranked.drop("_rank")


def dedup_first(
    df: DataFrame, key_cols: Sequence[str] = ("artist_name", "track_name"), order_col: Column | str = "doc_id",
) -> DataFrame:
    """One row per key, the first in ``order_col`` (a column or an
    expression, e.g. a struct, that orders the collection). Exact and
    case-sensitive; the key is the column pair, not a joined string.
    Repeatable under any partitioning.

    Every non-key column travels in the ``min_by`` struct, so project to the
    columns you need first."""
    keys = list(key_cols)
    rest = [c for c in df.columns if c not in keys]
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def count_per_group(df: DataFrame, group_col: str = "artist_name", out_col: str = "songs") -> DataFrame:
    """A1 / A3: rows per group (partial aggregate before the shuffle)."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias(out_col))


def totals(df: DataFrame, group_col: str = "artist_name") -> DataFrame:
    """A2: one row with the total record count and the number of groups."""
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct(group_col).alias("groups")
    )


def kept_groups(
    df: DataFrame, group_col: str = "artist_name", order_col: str | None = None,
    target: int | None = TARGET_SONGS,
) -> DataFrame:
    """The groups a collector keeps when it takes groups in order
    and stops after the group that brings the total to ``target`` (None: never).

    A group is kept when the rows of all groups before it number fewer than
    ``target``; so the total may pass ``target``. Returns one row per kept
    group with its row count and the count before it. A null group is a group
    like any other and comes first.
    """
    order_col = order_col or group_col
    per_group = df.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("songs"),
        *([] if order_col == group_col else [F.min(order_col).alias("_order")]),
    )
    order = [group_col] if order_col == group_col else ["_order", group_col]
    with_prior = exclusive_prefix_sum(per_group, order, "songs", "prior_songs")
    if target is not None:
        with_prior = with_prior.where(F.col("prior_songs") < target)
    return with_prior.drop(*([] if order_col == group_col else ["_order"]))


def cap_at_target(
    df: DataFrame, group_col: str = "artist_name", order_col: str | None = None,
    target: int | None = TARGET_SONGS,
) -> DataFrame:
    """Rows of the kept groups only (null-safe). ``df`` is read twice, for
    the counts and for the rows: pass a materialized, narrow frame."""
    if target is None:
        return df
    kept = kept_groups(df, group_col, order_col, target).select(F.col(group_col).alias("_kept"))
    return df.join(kept, F.col(group_col).eqNullSafe(F.col("_kept")), "left_semi")


def merge_corpora(first: DataFrame, second: DataFrame, columns: Sequence[str] = SONG_COLUMNS) -> DataFrame:
    """Both corpora, duplicates kept, matched by column name."""
    cols = list(columns)
    return first.select(*cols).unionByName(second.select(*cols))
