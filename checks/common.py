"""Helpers of the query registry."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle."""
    def register(build):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def percent_sql(part: str, total: str) -> str:
    """Percentage with two decimals, half up, in whole-number arithmetic."""
    half_up = f"CAST((abs({part}) * 20000 + ({total})) // NULLIF(2 * ({total}), 0) AS DOUBLE) / 100"
    return f"(sign({part}) * {half_up})"


def average_sql(value: str) -> str:
    """Mean of two-decimal values with two decimals, half up, in whole-number arithmetic."""
    cents = f"SUM(CAST({value} * 100 AS BIGINT))"
    return f"CAST(CAST((2 * {cents} + COUNT({value})) // NULLIF(2 * COUNT({value}), 0) AS DOUBLE) / 100 AS DECIMAL(8,2))"


def mean6_sql(value: str) -> str:
    """Mean of two-decimal values with six decimals, half up."""
    cents = f"SUM(CAST({value} * 100 AS BIGINT))"
    return f"CAST(CAST((20000 * {cents} + COUNT({value})) // NULLIF(2 * COUNT({value}), 0) AS DOUBLE) / 1000000 AS DECIMAL(24,6))"


def fold_sql(source: str, keys: Sequence[str], order: Sequence[str], first: Sequence[str] = (),
             last: Sequence[str] = (), last_value: Sequence[str] = (), first_value: Sequence[str] = (),
             nulls_match: bool = False, extra: str = "") -> str:
    """Upsert result by ranking the changes of every key."""
    ascending = ", ".join(order)
    lone = "0" if nulls_match else (
        "CASE WHEN " + " OR ".join(f"{k} IS NULL" for k in keys) + " THEN position END")
    columns = [f"MAX({c}) FILTER (WHERE up = 1) AS {c}" for c in first]
    columns += [f"MAX({c}) FILTER (WHERE down = 1) AS {c}" for c in last]
    columns += [f"arg_max({c}, up) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in last_value]
    columns += [f"arg_min({c}, up) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in first_value]
    group = ", ".join(keys)
    listed = ", ".join([*keys, *columns]) + extra
    return f"""
SELECT {listed} FROM (
 SELECT *, row_number() OVER (PARTITION BY {group}, lone ORDER BY position) AS up,
  row_number() OVER (PARTITION BY {group}, lone ORDER BY position DESC) AS down
 FROM (SELECT *, {lone} AS lone FROM (
  SELECT *, row_number() OVER (ORDER BY {ascending}) AS position FROM {source}) numbered) keyed) ranked
GROUP BY {group}, lone"""
