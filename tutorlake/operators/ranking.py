"""Ranking inside groups without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tutorlake.session import stored


def latest_flag(df: DataFrame, group: str, order: Sequence[str], flag: str = "is_latest") -> DataFrame:
    """1 on the row of each group with the greatest ``order`` values, NULLs lowest.

    Only rank one matters, so a partial ``max`` of the order columns replaces a
    window: a group with very many rows is reduced where its rows lie.  The last
    order column must be unique within the group.
    """
    rank = F.struct(*order)
    winners = df.groupBy(F.col(group).alias("__group")).agg(F.max(rank).alias("__best"))
    joined = df.join(winners, F.col(group).eqNullSafe(F.col("__group")), "left")
    is_best = F.lit(True)
    for name in order:
        is_best = is_best & F.col(name).eqNullSafe(F.col("__best").getField(name))
    return joined.select(*df.columns, F.when(is_best, 1).otherwise(0).alias(flag))


def latest_row(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The row of each group with the greatest ``order`` values."""
    row = F.struct(*[c for c in df.columns if c != group])
    picked = df.groupBy(group).agg(F.max_by(row, F.struct(*order)).alias("__row"))
    return picked.select(group, "__row.*").select(*df.columns)


def number_by_day(df: DataFrame, group: str, day: str, tie: str, number: str = "row_number") -> DataFrame:
    """Row number inside ``group`` ordered by ``day``, then ``tie``; rows without a group get none.

    An unknown day comes after all others.  The rows are dealt out by ranges of (group, day, tie) and stored, so a
    large group, or one with very many rows of one day or of none, spreads over as many tasks as its rows fill.  A
    row's number is its place in its range, counted from the group's first row there, plus the group's rows in the
    ranges before.  What is added up per group is one count per range.  ``tie`` should be unique within the group.
    """
    order = [F.col(group), F.asc_nulls_last(F.col(day).cast("date")), F.col(tie)]
    kept = [c for c in df.columns if c != number]
    ranged = df.select(*kept).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    ranged = ranged.withColumn("__range", F.shiftright("__at", 33))
    cells = ranged.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    same_cell = (F.col(group) == F.col("__g")) & (F.col("__range") == F.col("__r"))
    return ranged.join(offsets, same_cell, "left").select(
        *kept, (F.col("__before") + F.col("__at") - F.col("__first") + 1).cast("int").alias(number))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
