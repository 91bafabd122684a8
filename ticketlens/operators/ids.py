"""Contiguous ids (1..N in a stated order) and running totals without a single-task window.

``row_number()`` over an unpartitioned window pulls every row into one task. Here the rows are
range-partitioned on the full order key (sampled bounds split even a hot leading key, because the
order key ends in a unique column), each partition is sorted locally, one tiny aggregate counts
rows per partition, and the per-partition offsets (one row per partition: a size bound we know) are
broadcast back. ``monotonically_increasing_id`` is (partition << 33) + position inside the
partition, so position = mid − (pid << 33) with no second shuffle.

The tagged frame is materialised once as a written table in the shared checkpoint folder before it feeds both the count branch and the id branch. Without it each branch would run
its own range exchange (column pruning makes them differ, so no exchange reuse), sampling its own
range bounds; after an upstream shuffle the sample — and so the partition of a row — can differ
between the two, and ids would silently be wrong. The checkpoint also keeps a lost executor from
recomputing partitions with different bounds.

``repartitionByRange`` samples its input before it shuffles it, so what lies above the last shuffle
or scan runs once for the bounds and once for the rows; callers select the columns they need first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.session import materialise


def _materialise(df: DataFrame) -> DataFrame:
    """Written table in the session's shared checkpoint folder (see :func:`materialise`)."""
    return materialise(df, "tagged")


def _cols(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def with_contiguous_id(df: DataFrame, order_by: list, id_col: str,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..N following ``order_by`` (which should make rows unique)."""
    order = _cols(order_by)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    tagged = _materialise(ranged.sortWithinPartitions(*order)
                          .withColumn("_pid", F.spark_partition_id())
                          .withColumn("_mid", F.monotonically_increasing_id()))
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (F.col("_off") + pos + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))


def range_tagged(df: DataFrame, order_by: list) -> DataFrame:
    """``df`` range-partitioned and sorted on ``order_by`` with its partition id in ``_pid`` and a
    number that increases with the order in ``_pos``, written once: partition ids increase with the
    order (AQE only merges neighbouring ranges), and the stored copy keeps every later reader on
    the same numbers."""
    order = _cols(order_by)
    return _materialise(df.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_pos", F.monotonically_increasing_id()))


def with_running_total(df: DataFrame, order_by: list, weight: str, out_col: str,
                       tagged: bool = False) -> DataFrame:
    """Add ``out_col`` = sum of ``weight`` over all rows strictly before this one in ``order_by``.

    Meant for aggregated frames (e.g. value → count tables). Same range-partition + broadcast
    offsets scheme as :func:`with_contiguous_id`; the in-partition running sum is a window keyed by
    the partition id, so each range partition stays one task. ``tagged=True`` means ``df`` already
    comes from :func:`range_tagged` on the same order.
    """
    order = _cols(order_by)
    tagged = df if tagged else range_tagged(df, order)
    w_in = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_local", F.coalesce(F.sum(weight).over(w_in), F.lit(0)))
    per_part = tagged.groupBy("_pid").agg(F.sum(weight).alias("_n"))
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out_col, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_pos", "_local", "_off"))
