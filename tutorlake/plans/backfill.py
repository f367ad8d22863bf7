"""Historical enrolments and students into the entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tutorlake.functions import clean
from tutorlake.operators import dedup, upsert
from tutorlake.operators.policies import TRANSACTIONS_BACKFILL, TRANSACTIONS_INSERT_ONLY, USERS_BACKFILL

IMPORT_TYPE = "csv.import"
IMPORT_SOURCE = "csv"


def enrolment_rows(enrolments: DataFrame) -> DataFrame:
    """Transaction rows from raw enrolments (all text); rows without a usable user id are dropped."""
    return enrolments.select(
        "source_row",
        clean.epoch_or_null("user_id").alias("user_id"),
        clean.epoch_or_null("bundle_id").alias("bundle_id"),
        clean.epoch_or_null("master_batch_id").alias("master_batch_id"),
        clean.synthetic_id("csv-enrollment-", "source_row").alias("event_id"),
        F.lit(IMPORT_TYPE).alias("event_type"),
        "email", F.col("name").alias("full_name"), F.col("class_name").alias("course_name"), "master_batch_name",
        clean.epoch_or_null("institution_bundle_id").alias("institution_bundle_id"),
        clean.epoch_ts(clean.epoch_or_null("classusers_start_date")).alias("start_date"),
        clean.epoch_ts(clean.epoch_or_null("classusers_end_date")).alias("end_date"),
        F.lit(IMPORT_SOURCE).alias("source"),
    ).filter(F.col("user_id").isNotNull())


def backfill_transactions(enrolments: DataFrame, target: DataFrame | None = None, insert_only: bool = False) -> DataFrame:
    """Enrolments into transactions: existing rows win, gaps in name and e-mail are filled."""
    rule = TRANSACTIONS_INSERT_ONLY if insert_only else TRANSACTIONS_BACKFILL
    rows = enrolment_rows(enrolments)
    if target is None:
        return upsert.fold(rows, rule.keys, ["source_row"], rule.policies)
    return upsert.apply(target, rows, rule.keys, ["source_row"], rule.policies)


def email_map(enrolments: DataFrame) -> DataFrame:
    """One user id per normalised e-mail (the smallest, so that the choice never varies)."""
    pairs = enrolments.select(
        clean.normalise_email("email").alias("email_key"), clean.safe_int("user_id").alias("user_id"),
    ).filter(F.col("email_key").isNotNull() & F.col("user_id").isNotNull())
    return dedup.smallest_per_key(pairs, "email_key", "user_id")


def _students_with_key(students: DataFrame) -> DataFrame:
    return students.filter(F.col("email").isNotNull()).withColumn("email_key", clean.normalise_email("email"))


def resolved_students(students: DataFrame, enrolments: DataFrame) -> DataFrame:
    """User rows of the students whose e-mail belongs to a known user."""
    matched = _students_with_key(students).join(email_map(enrolments), "email_key")
    return matched.select(
        "source_row", "user_id",
        clean.synthetic_id("csv-student-", "source_row").alias("event_id"),
        F.lit(IMPORT_TYPE).alias("event_type"),
        "email", F.col("name").alias("full_name"), F.col("username").alias("user_name"),
        "city", "state", "address",
        clean.parse_local_timestamp("date_created").alias("created_at"),
    )


def backfill_users(students: DataFrame, enrolments: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rule = USERS_BACKFILL
    rows = resolved_students(students, enrolments)
    if target is None:
        return upsert.fold(rows, rule.keys, ["source_row"], rule.policies)
    return upsert.apply(target, rows, rule.keys, ["source_row"], rule.policies)


def unresolved_students(students: DataFrame, enrolments: DataFrame) -> DataFrame:
    """Students with an e-mail that no user has, with their whole row as JSON."""
    left = _students_with_key(students).join(email_map(enrolments), "email_key", "left_anti")
    return left.select(
        "source_row", "email", clean.row_payload(*[c for c in students.columns if c != "source_row"]).alias("raw_row"))
