"""Display text for report values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def thousands(c: Column, missing: str = "-") -> Column:
    """Whole part with thousands separators."""
    whole = F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c))
    return F.coalesce(F.format_number(whole, 0), F.lit(missing))


def two_decimals(c: Column, missing: str = "-") -> Column:
    return F.coalesce(F.format_number(c, 2), F.lit(missing))


def percent(c: Column, missing: str = "--") -> Column:
    """One decimal and a percent sign."""
    return F.coalesce(F.format_string("%.1f%%", c.cast("double")), F.lit(missing))


def or_not_set(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("(not set)"))


def days_ago(epoch: Column, as_of: datetime | Column, missing: str = "-") -> Column:
    """``today``, ``yesterday`` or ``N days ago`` for an epoch second."""
    now = as_of if isinstance(as_of, Column) else F.lit(int(as_of.timestamp()))
    days = F.floor((now - epoch) / F.lit(86400))
    label = (
        F.when(days == 0, F.lit("today"))
        .when(days == 1, F.lit("yesterday"))
        .otherwise(F.concat(days.cast("string"), F.lit(" days ago")))
    )
    return F.when(epoch.isNull(), F.lit(missing)).otherwise(label)


def learning_model(viniyoga: Column, category: Column) -> Column:
    """``Viniyoga`` for flagged courses, else their own category."""
    return F.coalesce(F.when(viniyoga == "True", F.lit("Viniyoga")), category)
