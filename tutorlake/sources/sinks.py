"""Where results go: snapshots, derived tables, append-only logs, dead letters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tutorlake.operators import dedup


def write_snapshot(df: DataFrame, root: str, category: str, prefix: str, fmt: str = "json",
                   taken_at: datetime | None = None) -> str:
    """Raw copy under ``root/raw/<category>/<prefix>_<time>.<fmt>``; returns its path."""
    stamp = (taken_at or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{root}/raw/{category}/{prefix}_{stamp}.{fmt}"
    if fmt == "json":
        df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    elif fmt == "csv":
        df.write.mode("errorifexists").option("escape", '"').csv(path, header=True)
    else:
        raise ValueError("a snapshot is json or csv")
    return path


def overwrite(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a derived table as a whole."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def append_new(df: DataFrame, target: DataFrame, path: str, keys: list[str], seq: list[str]) -> None:
    """Append the first row of every key that the target lacks."""
    dedup.only_new(target, df, keys, seq).write.mode("append").parquet(path)


def write_dead_letters(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected messages as JSON lines with reason, raw body and content type."""
    rejects.select(
        F.col("failure_reason").alias("reason"), F.col("raw_body").alias("body"),
        *[F.col("content_type").alias("type")] * ("content_type" in rejects.columns),
        *[c for c in ("seq", "received_at") if c in rejects.columns],
    ).write.mode(mode).json(path)


def write_summary_csv(export: DataFrame, path: str) -> None:
    export.write.mode("overwrite").csv(path, header=True)
