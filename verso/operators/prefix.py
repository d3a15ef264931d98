"""Exclusive running sum in a global order, spread over many tasks.

A plain ``sum(..).over(Window.orderBy(..))`` moves every row into one task.
Here the rows are range-sorted (many partitions), each row gets an id whose
upper bits are its sort partition, and the ids are fixed by a checkpoint.
Running sums are then taken inside each sort partition, and each partition
adds the total of the partitions before it. Only the per-partition totals
(one row per sort partition, a bound set by the shuffle width) are ever in
one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verso.session import materialize

# monotonically_increasing_id puts the partition index above bit 33.
_PARTITION_SHIFT = 33


def exclusive_prefix_sum(
    df: DataFrame, order_cols: list[str], value_col: str, out_col: str = "prior_sum"
) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows before this one
    in the order of ``order_cols`` (0 for the first row).

    ``order_cols`` must identify a row (ties would make "before" depend on
    the shuffle).
    """
    ordered = df.orderBy(*order_cols).withColumn("_rid", F.monotonically_increasing_id())
    ordered = materialize(
        ordered.withColumn("_part", F.shiftright("_rid", _PARTITION_SHIFT))
    )

    before = Window.unboundedPreceding
    totals = ordered.groupBy("_part").agg(F.sum(value_col).alias("_part_total"))
    offsets = totals.select(
        "_part",
        F.coalesce(
            F.sum("_part_total").over(Window.orderBy("_part").rowsBetween(before, -1)),
            F.lit(0),
        ).alias("_offset"),
    )
    local = ordered.withColumn(
        "_local",
        F.coalesce(
            F.sum(value_col).over(
                Window.partitionBy("_part").orderBy("_rid").rowsBetween(before, -1)
            ),
            F.lit(0),
        ),
    )
    # offsets has one row per sort partition: a bounded broadcast.
    return (
        local.join(F.broadcast(offsets), "_part")
        .withColumn(out_col, (F.col("_local") + F.col("_offset")).cast("bigint"))
        .drop("_part", "_rid", "_local", "_offset")
    )
