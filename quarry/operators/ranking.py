"""Exact global row numbers without a single-partition window.

``row_number() over (order by ...)`` with no partition key moves every row into one
task. Here the frame is range-partitioned by a global sort, its layout is fixed with a
reliable ``checkpoint()`` (shared folder), each partition's row count is taken (one
small row per partition), and a row's number is the rows of earlier partitions plus its
position inside its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1   # monotonically_increasing_id: partition id << 33 | record number


def global_index(df: DataFrame, order: Sequence[Column | str], out: str = "index", start: int = 0) -> DataFrame:
    """Add ``out`` = start-based position of each row in the total order ``order``.

    ``order`` must be a total order (add a unique tie-breaker) for the numbers to be
    deterministic.
    """
    from quarry.session import shared_root
    shared_root(df.sparkSession)
    fixed = df.orderBy(*order).checkpoint()
    tagged = fixed.select("*", F.spark_partition_id().alias("_pid"),
                          (F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))).alias("_pos"))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per partition: bounded by the partition count
    return (tagged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
            .drop("_pid", "_pos", "_off"))
