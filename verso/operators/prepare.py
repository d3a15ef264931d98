"""Training-row preparation, the repeatable split and the repeatable sample (P1-P5, A3,
M11)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verso.operators.counts import RowCounts
from verso.functions.text import TRAIN_MIN_CHARS, has_min_chars
from verso.schema import SONG_COLUMNS, require_columns
from verso.session import materialize

# Split share of the reference (80/20).
TRAIN_BUCKETS = 8
SPLIT_BUCKETS = 10


def prepare_rows(
    df: DataFrame, columns: Sequence[str] = SONG_COLUMNS, keep: Sequence[str] = (),
    min_chars: int = TRAIN_MIN_CHARS, counts: RowCounts | None = None, step: str = "prepare",
) -> DataFrame:
    """Project, year to int, text strictly longer than ``min_chars``,
    then drop rows with a null in any projected column.

    ``counts`` gets, under ``step``, the rows read, too short (or without a text), incomplete
    (long enough, with a null) and prepared.

    ``try_cast`` gives null for a bad year where a plain cast would fail
    under ANSI mode; such rows then leave with the null check, as in the
    reference.
    """
    cols = list(columns)
    require_columns(df, [*keep, *cols])
    out = df.select(*keep, *cols)
    if "release_date" in cols:
        out = out.withColumn("release_date", F.col("release_date").try_cast("int"))
    if counts is not None:
        long = has_min_chars("lyrics", min_chars, strict=True)
        full = reduce(and_, [F.col(c).isNotNull() for c in cols])
        out = counts.watch(out, step, read=F.lit(True), too_short=~long, incomplete=long & ~full, prepared=long & full)
    out = out.where(has_min_chars("lyrics", min_chars, strict=True))
    return out.na.drop(subset=cols)


def prepare_text_rows(
    df: DataFrame, keep: Sequence[str] = (), min_chars: int = TRAIN_MIN_CHARS, counts: RowCounts | None = None,
    step: str = "prepare",
) -> DataFrame:
    """P5 on (genre, lyrics) only: rows without a year are not lost."""
    return prepare_rows(df, ("genre", "lyrics"), keep, min_chars, counts, step)


def class_distribution(df: DataFrame, label_col: str = "genre") -> DataFrame:
    """A3: rows per class."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def hash_bucket(id_col: Column | str, buckets: int = SPLIT_BUCKETS) -> Column:
    """Bucket from the first 32 bits of md5(id): the same for the same id on
    any partitioning, unlike ``randomSplit``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % buckets).cast("int")


def hash_split(
    df: DataFrame, id_col: str = "doc_id", train_buckets: int = TRAIN_BUCKETS,
    buckets: int = SPLIT_BUCKETS, counts: RowCounts | None = None, step: str = "split",
) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train / test split by id hash (80/20). ``counts`` gets the
    rows of both parts; a read of either part counts both."""
    b = hash_bucket(id_col, buckets)
    if counts is not None:
        df = counts.watch(df, step, train=b < train_buckets, test=b >= train_buckets)
    return df.where(b < train_buckets), df.where(b >= train_buckets)


def with_fold(df: DataFrame, id_col: str = "doc_id", folds: int = 3, out_col: str = "fold") -> DataFrame:
    """Repeatable cross-validation fold per row (from a second hash, so
    folds do not line up with the train/test buckets)."""
    c = F.col(id_col).cast("string")
    h = F.conv(F.substring(F.sha1(c), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out_col, (h % folds).cast("int"))


# --------------------------------------------------------------- bottom-k sample

HASH_BITS = 60
STEP_BITS = 12


def sample_hash(id_col: Column | str) -> Column:
    """60-bit hash of a row id: the order in which rows enter a sample."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.xxhash64(F.lit("sample"), c.cast("string")).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def bottom_k_thresholds(df: DataFrame, k: int, group_col: str = "genre", id_col: str = "doc_id") -> DataFrame:
    """(group_col, threshold): the rows of a group whose ``sample_hash`` is below its
    threshold are its ``k`` smallest (all rows, if it has no more than ``k``).

    A selection by digits, no sort and no window over rows: the rows are counted by group
    and the first 12 bits of the hash (a partial aggregate, at most 4,096 rows a group
    and task). The sums tell how many of these buckets fit into ``k`` and which one
    holds the border; only its rows are counted by the next 12 bits. A group's rows are
    never in one task, and the result does not depend on the layout. Rows of one id have
    one hash: where they would straddle the border, none of them is taken, so ``k`` is
    an upper bound. Groups may be null.
    """
    rows = materialize(df.select(F.col(group_col).alias("_group"), sample_hash(id_col).alias("_h")))
    no_limit = F.lit(1 << HASH_BITS)
    open_groups = rows.select("_group").distinct().select("_group", F.lit(0).cast("bigint").alias("_prefix"), F.lit(k).cast("bigint").alias("_need"))
    found = None
    for left in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        state = materialize(open_groups)  # one row a group
        if state.isEmpty():
            break
        on = rows["_group"].eqNullSafe(state["_group"]) & (F.shiftright("_h", left + STEP_BITS) == F.col("_prefix"))
        inside = rows.join(state, on).select(rows["_group"], "_prefix", "_need", F.shiftright("_h", left).alias("_bucket"))
        counts = inside.groupBy("_group", "_prefix", "_need", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        up_to = F.sum("_n").over(Window.partitionBy("_group").orderBy("_bucket"))  # at most 4,096 rows a group
        border = counts.withColumn("_up_to", up_to).where("_up_to > _need").groupBy("_group", "_need").agg(F.min(F.struct("_bucket", (F.col("_up_to") - F.col("_n")).alias("_before"))).alias("_b"))
        cut = materialize(state.select("_group").join(border.withColumnRenamed("_group", "_g"), F.col("_group").eqNullSafe(F.col("_g")), "left").drop("_g"))
        # no border: all rows fit; nothing needed of the border bucket: it is the threshold
        done = F.col("_b").isNull() | (F.col("_need") == F.col("_b._before"))
        if left == 0:
            done = F.lit(True)  # rows of one hash
        at = F.coalesce(F.shiftleft(F.col("_b._bucket"), left), no_limit)
        closed = cut.where(done).select("_group", at.alias("threshold"))
        found = closed if found is None else found.unionByName(closed)
        open_groups = cut.where(~done).select("_group", F.col("_b._bucket").alias("_prefix"), (F.col("_need") - F.col("_b._before")).alias("_need"))
    if found is None:
        found = rows.select("_group", F.lit(0).cast("bigint").alias("threshold")).limit(0)
    return found.withColumnRenamed("_group", group_col)


def sample_per_class(df: DataFrame, k: int | None, label_col: str = "genre", id_col: str = "doc_id") -> DataFrame:
    """At most ``k`` rows of each class, those of the smallest id hash; None: all rows.
    The same rows from any layout; a class of at most ``k`` rows stays whole."""
    if k is None:
        return df
    limit = bottom_k_thresholds(df, k, label_col, id_col).withColumnRenamed(label_col, "_class")
    return df.join(limit, F.col(label_col).eqNullSafe(F.col("_class")) & (sample_hash(id_col) < F.col("threshold")), "left_semi")
