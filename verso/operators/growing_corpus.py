"""A corpus that grows over runs (U2, A4): appends against a bucketed key table.

The collector keeps the keys of the songs it has (artist and title) and skips songs that
it meets again, in later runs too. Here a corpus is a folder on shared storage:

    FOLDER/keys/     one narrow row (key, attempt) for each song, bucketed by key
    FOLDER/songs/    the songs, a folder for each attempt
    FOLDER/runs/     one row (run, attempt, songs) for each finished run, written last

An append removes repeats inside the new rows (a partial aggregate) and anti-joins the
rest with the keys. These are already dealt by key, so only the new rows are shuffled, to
the buckets; the old side is read in place. ``buckets`` is fixed when the corpus is made,
for the size that it is to reach (a key is some 100 bytes; 100 to 200 MB a bucket).

Every try of a run writes under an attempt id of its own, and only attempts with a row
in ``runs`` count. So a try that failed anywhere leaves rows that no reader sees, repeating
it is safe, and repeating a finished run adds nothing. On the driver is one id a run.

Cases: a null artist or title is a value like any other (two nulls are equal). Of equal
new rows the first in ``order_col`` stays. An append without new songs is a finished run of
0 songs. Appends to one corpus must not run at the same time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verso.operators.corpus import dedup_first
from verso.session import materialize

BUCKETS = 64
_RUNS = "run long, attempt string, songs long"


def song_key(artist: str = "artist_name", title: str = "track_name") -> Column:
    """One key of an artist and a title, nulls told apart from texts: the artist's length
    keeps ("a", "bc") and ("ab", "c") apart."""
    mark = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))
    return F.sha2(F.concat_ws(":", F.coalesce(F.length(artist), F.lit(-1)).cast("string"), mark(artist), mark(title)), 256)


class GrowingCorpus:
    """The corpus in ``folder``; made if it is not there."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, buckets: int = BUCKETS):
        self.spark, self.folder, self.schema, self.buckets = spark, folder.rstrip("/"), schema, int(buckets)
        # Registers the folder in this session; its files carry their bucket.
        self.keys_table = "corpus_keys_" + hashlib.sha256(self.folder.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.keys_table} (key STRING, attempt STRING) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/keys'"
        )

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def runs(self) -> DataFrame:
        """(run, attempt, songs) of the finished runs."""
        return self._read("runs", _RUNS)

    def _attempts(self) -> list[str]:
        return [r["attempt"] for r in self.runs().select("attempt").collect()]  # one a run

    def keys(self) -> DataFrame:
        """(key) of every song; read in buckets, without a shuffle."""
        return self.spark.table(self.keys_table).where(F.col("attempt").isin(self._attempts())).select("key")

    def new_rows(self, rows: DataFrame, order_col: Column | str = "doc_id") -> DataFrame:
        """The rows whose song the corpus does not have, one of each song, with ``_key``.
        Only ``rows`` is shuffled."""
        first = dedup_first(rows.withColumn("_key", song_key()), ("_key",), order_col)
        old = self.keys().select(F.col("key").alias("_old"))
        # To as many parts as there are buckets, or the planner might deal the old side
        # anew; an outer join, because it would move an anti-join below the dealing.
        both = first.repartition(self.buckets, "_key").join(old.hint("merge"), F.col("_key") == F.col("_old"), "left")
        return both.where(F.col("_old").isNull()).drop("_old")

    def append(self, rows: DataFrame, run: int, order_col: Column | str = "doc_id", after: Callable[[str], None] = lambda step: None) -> int:
        """Add the new songs of ``rows`` as run ``run``; returns how many the run has. A
        finished run is not added again. ``after`` is called with the name of each
        finished step (tests stop a run there)."""
        done = self.runs().where(F.col("run") == run).select("songs").first()
        if done is not None:
            return done["songs"]
        attempt = uuid.uuid4().hex
        fresh = materialize(self.new_rows(rows.select(*self.schema.names), order_col))  # read for songs, keys and the count
        fresh.select(*self.schema.names).write.parquet(f"{self.folder}/songs/attempt={attempt}")
        after("songs")
        keys = fresh.select(F.col("_key").alias("key"), F.lit(attempt).alias("attempt"))
        keys.write.insertInto(self.keys_table)
        after("keys")
        n = fresh.count()
        self.spark.createDataFrame([(run, attempt, n)], _RUNS).coalesce(1).write.mode("append").parquet(f"{self.folder}/runs")
        after("runs")
        return n

    def songs(self) -> DataFrame:
        """All songs with their run."""
        whole = T.StructType([*self.schema.fields, T.StructField("attempt", T.StringType())])
        runs = self.runs().select("attempt", "run")
        return self._read("songs", whole).where(F.col("attempt").isin(self._attempts())).join(runs, "attempt").select(*self.schema.names, "run")
