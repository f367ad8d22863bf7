"""The queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.llm import (
    alignment, debruijn, kneserney, mixing, oracles, pii, quality, secrets, sharding, similar, suffixes, templates, topk, variants,
)
from tutorlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


@_query("op1_ngram_jaccard_join", oracles.OP1)
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.similarity_classes(table(spark, sf_dir, "documents"))


@_query("op2_source_mixing")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@_query("op4_quality_classifier")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op8_benchmark_decontamination")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op9_sharding")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(table(spark, sf_dir, "documents"))


@_query("op3_secret_scan")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


@_query("op10_personal_data")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@_query("op7_topk_search", oracles.OP7)
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op5_substring_dedup", oracles.OP5)
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.without_repeats(table(spark, sf_dir, "documents"))


@_query("op6_suffix_array_dedup")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeated_bytes(table(spark, sf_dir, "documents"))


@_query("op11_tokenizer_alignment")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_measures(table(spark, sf_dir, "documents"))


@_query("op12_language_model_scores")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.language_scores(table(spark, sf_dir, "documents"))


@_query("op13_spelling_variants", oracles.OP13)
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
