"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from tutorlake.plans.reports import row_counts, union_all

__all__ = ["row_counts", "columns", "sample", "latest", "populated", "layer_gap", "split_test_rows", "test_row_counts"]


def columns(tables: Mapping[str, DataFrame], approximate: bool = False) -> DataFrame:
    """Profile of every column: type, rows, NULLs and distinct values.

    Each table is turned into (column, value) cells and reduced on the map side
    to distinct cells, so any number of exact distinct counts costs one shuffle.
    ``approximate`` replaces that by one pass with sketches.
    """
    return union_all([_profile(name, df, approximate) for name, df in sorted(tables.items())])


def _profile(table: str, df: DataFrame, approximate: bool) -> DataFrame:
    kinds = F.create_map(*[F.lit(v) for f in df.schema.fields for v in (f.name, f.dataType.simpleString())])
    if approximate:
        stats = [F.struct(
            F.lit(c).alias("column_name"), F.count("*").alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.approx_count_distinct(c).alias("distinct_count")) for c in df.columns]
        counted = df.agg(F.array(*stats).alias("stats")).select(F.explode("stats").alias("s")).select("s.*")
    else:
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns
        ])).alias("cell")).select("cell.*")
        counted = (
            cells.groupBy("column_name", "value").agg(F.count("*").alias("n"))
            .groupBy("column_name").agg(
                F.sum("n").alias("row_count"),
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
                F.count("value").alias("distinct_count")))
    return counted.select(
        F.lit(table).alias("table_name"), "column_name", kinds[F.col("column_name")].alias("data_type"),
        "row_count", "null_count", "distinct_count")


def sample(df: DataFrame, keys: Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows by key, so that the sample never varies."""
    return df.orderBy(*keys).limit(rows)


def latest(df: DataFrame, by: str, keys: Sequence[str], rows: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), *keys).limit(rows)


def preview(body: Column, length: int = 100) -> Column:
    return F.left(body, F.lit(length))


def populated(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``OK``, ``EMPTY`` or ``ERROR`` (the table cannot be read) per table."""
    parts = []
    for name in sorted(names):
        try:
            counted = spark.table(name).agg(F.count("*").alias("row_count"))
        except AnalysisException:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "row_count"))
    status = F.when(F.col("row_count") > 0, "OK").when(F.col("row_count") == 0, "EMPTY").otherwise("ERROR")
    return union_all(parts).withColumn("status", status)


def layer_gap(pairs: Mapping[str, tuple[DataFrame, DataFrame]], required: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Bronze and silver rows per entity; ``gap`` where silver is empty although bronze is not.

    ``unexpected_nulls`` counts silver rows that lack one of their required columns.
    """
    parts = []
    for name, (bronze, silver) in sorted(pairs.items()):
        lacking = F.lit(False)
        for column in (required or {}).get(name, ()):
            lacking = lacking | F.col(column).isNull()
        zero = F.lit(0).cast("bigint")
        counted = bronze.agg(F.count("*").alias("b"), zero.alias("s"), zero.alias("u")).unionByName(
            silver.agg(zero.alias("b"), F.count("*").alias("s"), F.count_if(lacking).alias("u")))
        parts.append(counted.agg(
            F.sum("b").alias("bronze_rows"), F.sum("s").alias("silver_rows"), F.sum("u").alias("unexpected_nulls"),
        ).withColumn("entity", F.lit(name)))
    gap = (F.col("bronze_rows") > 0) & (F.col("silver_rows") == 0)
    return union_all(parts).select("entity", "bronze_rows", "silver_rows", gap.alias("gap"), "unexpected_nulls")


def split_test_rows(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Test rows and the rows that stay."""
    return df.filter(predicate), df.filter(~predicate)


def test_row_counts(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Test rows found and rows kept per table, before anything is removed."""
    return union_all([
        df.agg(F.count_if(predicate).alias("found"), F.count_if(~predicate).alias("kept"))
        .select(F.lit(name).alias("table_name"), "found", "kept")
        for name, (df, predicate) in sorted(tables.items())])
