"""Driver tables and the song-table stand-in built from them.

The song table (artist_name, track_name, release_date, genre, lyrics) is
derived from ``documents``:

* artist_name  = documents.source
* track_name   = documents.text (the whole text: documents have no title)
* release_date = year of the stand-in song date, see ``song_date`` (int)
* genre        = documents.lang
* lyrics       = documents.text
* doc_id       = documents.doc_id (tie-breaks)

``detail_years`` gives the fallback year: the first 4-digit run in the html of
the page with the same id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verso.functions.text import first_year
from verso.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def song_date(doc_id: Column | str = "doc_id") -> Column:
    """Stand-in release date of a document: missing for some ids, year 0000 for
    others, else a date between 1950 and 2022."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    year = F.when(c % 13 == 0, F.lit("0000")).otherwise((c % 73 + 1950).cast("string"))
    return F.when(c % 11 != 0, F.concat(year, F.lit("-06-15")))


def page_years(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One (_detail_id, _detail_year) row per detail record that holds a year.

    The regex runs once per html and before any shuffle, so only (id, year)
    moves, never the html (the aggregate skips nulls, so no filter repeats the
    regex). Duplicate ids collapse to their smallest year with a partial
    (map-side) aggregate, which keeps a hot id from multiplying the join.
    """
    years = pages.select(F.col(id_col).alias("_detail_id"), first_year(html_col).alias("_y"))
    return years.groupBy("_detail_id").agg(F.min("_y").alias("_detail_year")).where(F.col("_detail_year").isNotNull())


def song_records(documents: DataFrame) -> DataFrame:
    """Map ``documents`` onto the song schema; row-local."""
    return documents.select(
        "doc_id",
        F.col("source").alias("artist_name"),
        F.col("text").alias("track_name"),
        first_year(song_date()).try_cast("int").alias("release_date"),
        F.col("lang").alias("genre"),
        F.col("text").alias("lyrics"),
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return song_records(spread(read_table(spark, sf_dir, "documents")))


def song_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, release_date): the year of the song's own date, else the page's.

    The song's date is its whole text; only where the texts would leave a branch idle is it
    made from the id (no date, or year 0000). The year is taken row-locally, so only ids
    and years are joined."""
    docs, c = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("doc_id")
    date = F.when(c % 13 == 0, F.lit("0000-06-15")).when(c % 11 != 0, F.col("text"))
    ids = docs.select("doc_id", first_year(date).alias("_song_year"))
    found = ids.join(page_years(read_table(spark, sf_dir, "pages")), ids["doc_id"] == F.col("_detail_id"), "left")
    return found.select("doc_id", F.coalesce("_song_year", "_detail_year").try_cast("int").alias("release_date"))
