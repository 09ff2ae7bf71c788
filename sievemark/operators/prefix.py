"""Running totals over a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.storage import materialize


def prefix_sum(
    df: DataFrame,
    order_by: str,
    value: str | Column,
    by: Sequence[str] = (),
    out: str = "offset",
    ranges: int | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same ``by`` group.

    Rows are dealt out by ranges of ``order_by`` and written with the number of
    their range, so that number never changes. Each range is summed, the range
    totals (one per range and group) are accumulated, and a window adds the
    position inside one range. A group of any size is spread over many tasks,
    because a range is never the group. Rows of one key share a range; among
    them the order is arbitrary. ``ranges`` is by default the session's number
    of shuffle partitions, which should follow the size of the data.
    """
    amount = F.col(value) if isinstance(value, str) else value
    keyed = df.withColumn("_amount", amount)
    placed = keyed.repartitionByRange(ranges, order_by) if ranges else keyed.repartitionByRange(order_by)
    written = materialize(placed.withColumn("_range", F.spark_partition_id()), "ranges")
    keys = [*by, "_range"]
    totals = written.groupBy(*keys).agg(F.sum("_amount").alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        written.join(starts, keys)
        .withColumn(out, F.col("_start") + F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .drop("_range", "_amount", "_start")
    )


def global_index(
    df: DataFrame, order_by: str, by: Sequence[str] = (), out: str = "row_index", ranges: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row within its ``by`` group.

    Without groups each range is written in its order, so that a row's place in
    its file is its position inside the range: rows move once, and the totals,
    one a file, are all that is joined.
    """
    if by:
        return prefix_sum(df, order_by, F.lit(1).cast("long"), by, out, ranges)
    placed = df.repartitionByRange(ranges, order_by) if ranges else df.repartitionByRange(order_by)
    in_order = placed.withColumn("_range", F.spark_partition_id()).sortWithinPartitions(order_by)
    written = materialize(in_order, "ranges")
    # A task leaves several files where files are limited; their names go on in order.
    rows = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_inside"))
    earlier = Window.orderBy("_range", "_file").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_range", "_file").agg(F.count(F.lit(1)).alias("_total"))
    starts = totals.select("_range", "_file", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    numbered = rows.join(F.broadcast(starts), ["_range", "_file"])
    return numbered.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(out))
