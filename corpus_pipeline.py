"""Corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage reads the documents that its predecessor kept and returns documents; the last returns their places.  Stages
decide row by row: rows that share an id, or have none, are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.llm import mixing, quality, sharding, similar, templates
from tutorlake.llm.common import table, unused, with_row
from tutorlake.session import remove_path, scratch_path, scratch_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as label 1; the model is fitted on the labelled rows among ``docs``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score, good = unused(docs, "_score"), unused(docs, "_good")
    return quality.scored(docs, model, score=score, predicted=good).filter(F.col(good) == 1).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, a row without id only where none has one.

    Of rows that share the smallest id the first stays.  Rows without words are no duplicates of each other.
    """
    rows, row = with_row(docs, "near-rows")
    classes = similar.similarity_classes(rows.select(F.col(row).alias("doc_id"), "text"))
    ids = rows.select(F.col(row).alias("doc_id"), F.col("doc_id").cast("long").alias("id"))
    kept = (classes.join(ids, "doc_id").groupBy("component_id")
            .agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "doc_id")).alias("least"))
            .select(F.col("least.doc_id").alias(row)))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items, verbatim or with other numbers and names."""
    return templates.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as many times as the mix takes it: not at all, once or twice."""
    return mixing.take_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The first stage is a fitted model, which SQL cannot express; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result but the last is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for place, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"pipeline-{place}")
        # A stage's own tables, and what the stage before has left, are not needed once its result is written.
        with scratch_scope(spark, "pipeline-stage"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
