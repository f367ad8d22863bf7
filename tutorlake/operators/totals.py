"""Running totals over an order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tutorlake.session import stored


def total_before(rows: DataFrame, order: Sequence[Column | str], value: str, name: str, label: str = "totals") -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows that come before.

    Rows are dealt out by ranges of the order and summed inside their range; one sum per range is gathered and
    laid out before the ranges that follow.  ``order`` should be unique.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("__part", F.shiftright("__at", 33)), label)
    sums = sorted(ranged.groupBy("__part").agg(F.sum(value).alias("n")).collect())
    starts, total = [], 0
    for part, n in sums:
        starts.append((part, total))
        total += n or 0
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.sparkSession.createDataFrame(starts, "__part bigint, __start bigint")
    return ranged.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(offsets, "__part").withColumn(
        name, F.col("__start") + F.col("__inside")).drop("__at", "__part", "__start", "__inside")
