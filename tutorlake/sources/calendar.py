"""Pull dates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tutorlake.functions.clean import day_window


def target_range(today: date, day: date | None = None, start: date | None = None,
                 end: date | None = None) -> tuple[date, date]:
    """First and last pull date: one day, a range ending yesterday by default, or yesterday."""
    yesterday = today - timedelta(days=1)
    if day is not None:
        return day, day
    if start is not None:
        return start, end or yesterday
    return yesterday, yesterday


def calendar(spark: SparkSession, start: date, end: date, zone: str = "Asia/Kolkata") -> DataFrame:
    """One row per day with the first and last epoch second of that local day; empty when end < start."""
    days = max((end - start).days + 1, 0)
    rows = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("pull_date"))
    first, last = day_window("pull_date", zone)
    return rows.select("pull_date", first.alias("start_epoch"), last.alias("end_epoch"))


def missing_days(pulled: DataFrame, days: DataFrame) -> DataFrame:
    """Days of the calendar that no pull covers yet."""
    return days.join(pulled.select("pull_date"), "pull_date", "left_anti")
