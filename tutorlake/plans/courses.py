"""Course catalogue, batches, lifecycle and the two course master tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import clean
from tutorlake.functions.jsonfields import first_truthy, text_at
from tutorlake.operators import dedup, predicates, upsert
from tutorlake.operators.policies import (
    CATALOGUE, CATALOGUE_FROM_CSV, CATALOGUE_INSERT_ONLY, CATALOGUE_RAW, COURSE_BATCHES, COURSE_BATCHES_RAW,
    LIFECYCLE, TableRule,
)
from tutorlake.operators.ranking import flag, latest_flag

# Alternate names of the catalogue fields in API replies.
CATALOGUE_FIELDS = {
    "course_name": ("Course Name", "course_name", "name"),
    "course_description": ("Course Description", "course_description"),
    "cost": ("Cost", "cost"),
    "num_students": ("Num Students", "num_students"),
    "tutors": ("Tutors", "tutors"),
    "course_url": ("Course URL", "course_url"),
    "subject": ("Subject", "subject"),
    "level": ("Level", "level"),
    "language": ("Language", "language"),
    "type": ("Type", "type"),
    "course_division": ("Course Division", "course_division"),
    "status": ("Status", "status"),
    "sss_category": ("SSS Category", "sss_category"),
    "viniyoga": ("Viniyoga", "viniyoga"),
    "adhyayanam_category": ("Adhyayanam Category", "adhyayanam_category"),
    "term_of_course": ("Term of Course", "term_of_course"),
    "position_in_funnel": ("Position in Funnel", "position_in_funnel"),
    "division": ("Division", "division"),
}
COURSE_DIVISION = "course"


def _upsert(changes: DataFrame, target: DataFrame | None, rule: TableRule, seq: list[str]) -> DataFrame:
    for key in rule.required:
        changes = changes.filter(F.col(key).isNotNull())
    if target is None:
        return upsert.fold(changes, rule.keys, seq, rule.policies)
    return upsert.apply(target, changes, rule.keys, seq, rule.policies)


# --- catalogue -------------------------------------------------------------

def catalogue_rows(items: DataFrame) -> DataFrame:
    """Raw catalogue rows from API items (``item`` VARIANT, ``seq``); items without an id are dropped."""
    item = F.col("item")
    course = F.coalesce(text_at(item, "bundle_id"), text_at(item, "Bundle id"), text_at(item, "id"))
    return items.select(
        clean.safe_int(course).alias("source_row"), "seq", course.alias("bundle_id"),
        *[clean.clean_text(first_truthy(item, *names)).alias(name) for name, names in CATALOGUE_FIELDS.items()],
        F.to_json(item).alias("raw_json"),
    ).filter(F.col("bundle_id").isNotNull())


def upsert_catalogue_raw(rows: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return _upsert(rows, target, CATALOGUE_RAW, ["seq"])


def judge_catalogue(raw: DataFrame) -> DataFrame:
    """Add the numeric ``course_key`` and ``verdict``: ``ok``, ``invalid_id`` or ``not_a_course``."""
    division = F.lower(clean.clean_text("course_division"))
    judged = raw.withColumn("course_key", clean.safe_bigint("bundle_id"))
    bad_id = F.col("course_key").isNull() | (F.col("course_key") == 0)
    not_course = division.isNull() | (division != COURSE_DIVISION)
    verdict = F.when(bad_id, F.lit("invalid_id")).when(not_course, F.lit("not_a_course")).otherwise(F.lit("ok"))
    return judged.withColumn("verdict", verdict)


def catalogue_from_raw(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Typed catalogue: valid courses only, the first raw row of a course counts."""
    valid = judge_catalogue(raw).filter(F.col("verdict") == "ok")
    first = dedup.first_seen(valid, ["course_key"], ["source_row"])

    def text(name: str) -> Column:
        return clean.clean_text(name) if name in raw.columns else F.lit(None).cast("string")

    special = {
        "course_type": text("type"),
        "status": predicates.listed_or_null(text("status")),
        "num_students": clean.safe_int("num_students", commas=True).try_cast("int"),
    }
    rows = first.select(
        F.col("course_key").alias("bundle_id"), "source_row",
        *[special.get(name, text(name)).alias(name) for name in CATALOGUE.policies],
    )
    return _upsert(rows, target, CATALOGUE, ["source_row"])


def catalogue_from_csv(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = raw.select(
        clean.safe_int("bundle_id", commas=True).alias("bundle_id"), "source_row",
        *[clean.clean_text(c).alias(c) for c in ("course_name", "subject", "status")],
        clean.safe_int("num_students", commas=True).try_cast("int").alias("num_students"),
    )
    return _upsert(rows, target, CATALOGUE_FROM_CSV, ["source_row"])


def catalogue_insert_only(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = raw.select(
        clean.safe_int("bundle_id", commas=True).alias("bundle_id"), "source_row",
        clean.clean_text("course_name", clean.NULL_TOKENS_SHORT).alias("course_name"),
        clean.safe_float("cost").alias("cost"),
    )
    return _upsert(rows, target, CATALOGUE_INSERT_ONLY, ["source_row"])


# --- lifecycle -------------------------------------------------------------

# Raw tracker columns behind the typed lifecycle columns.
LIFECYCLE_TEXTS = {
    "course_name": "course_name", "status": "status", "type_of_launch": "type_of_launch", "subject": "subject",
    "position_in_funnel": "position_in_funnel", "learning_model": "samskritadhyayana_model",
    "term_of_course": "term_of_course", "sss_category": "sss_category", "persona": "persona",
}
LIFECYCLE_DATES = {"first_class_date": "first_class_date", "last_class_date": "last_class_and_valedictory_date"}
LIFECYCLE_COUNTS = {
    "enrollments_on_fc": "enrolments_on_the_day_of_first_class",
    "enrollments_on_lc": "enrolments_on_last_day",
    "total_classes_held": "total_no_of_classes_held",
    "total_certified": "total_students_certified",
}
LIFECYCLE_DECIMALS = {
    "avg_attendance": ("average_attendance_of_all_classes", "decimal(8,2)"),
    "pass_percentage": ("pass_percentage_total_certified_vs_total_assessment_attendees", "decimal(5,2)"),
    "overall_rating": ("overall_course_rating", "decimal(3,2)"),
}


def upsert_lifecycle(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Typed lifecycle rows; a later row of the same course and batch only changes the status."""
    def raw_text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    # Each column comes from a whole row, the first or the last of its key.  So rows are picked as texts, and only those
    # that stay are parsed.
    sources = {**LIFECYCLE_TEXTS, **LIFECYCLE_DATES, **LIFECYCLE_COUNTS, **{n: src for n, (src, _) in LIFECYCLE_DECIMALS.items()}}
    texts = raw.select(
        clean.safe_int("course_id", commas=True).alias("course_id"), clean.clean_text("batch_name", ("", "None")).alias("batch_name"),
        "source_row", *[raw_text(src).alias(name) for name, src in sources.items()], raw_text("batch_id").alias("batch_id"))
    complete = texts.dropna(subset=list(LIFECYCLE.required))
    picked = upsert.fold(complete, LIFECYCLE.keys, ["source_row"], {**LIFECYCLE.policies, "source_row": upsert.FIRST})
    rows = picked.select(
        *LIFECYCLE.keys, "source_row",
        *[clean.clean_text(name).alias(name) for name in LIFECYCLE_TEXTS],
        *[clean.parse_date(clean.clean_text(name), clean.LIFECYCLE_DATE_FORMATS).alias(name) for name in LIFECYCLE_DATES],
        *[clean.safe_int(name, commas=True).try_cast("int").alias(name) for name in LIFECYCLE_COUNTS],
        *[clean.safe_float(name).try_cast(kind).alias(name) for name, (_, kind) in LIFECYCLE_DECIMALS.items()],
        clean.safe_int("batch_id", commas=True).alias("batch_id"),
    )
    return rows.drop("source_row") if target is None else _upsert(rows, target, LIFECYCLE, ["source_row"])


# --- batches ---------------------------------------------------------------

def batch_rows(batches: DataFrame) -> DataFrame:
    """Raw batch rows from flattened API batches (``batch`` VARIANT, promoted bundle columns, ``source_row``)."""
    batch = F.col("batch")
    archived = clean.clean_text(text_at(batch, "mb_archived")) == "1"
    return batches.select(
        "source_row",
        clean.clean_text("bundle_id").alias("bundle_id"),
        clean.clean_text("bundle_name").alias("bundle_name"),
        clean.clean_text(text_at(batch, "class_id")).alias("batch_id"),
        clean.clean_text(text_at(batch, "class_name")).alias("batch_name"),
        F.when(archived, F.lit("Archived")).otherwise(F.lit("Active")).alias("batch_status"),
        *[clean.clean_text(text_at(batch, c)).alias(c) for c in ("start_date", "end_date", "tutor_id", "tutor_name")],
        clean.clean_text(first_truthy(batch, "admitted_students", "registered_students")).alias("admitted_students"),
        (F.col("bundle_id").isNotNull() & text_at(batch, "class_id").isNotNull()).alias("__keyed"),
    ).filter("__keyed").drop("__keyed")


def upsert_batches_raw(rows: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return _upsert(rows, target, COURSE_BATCHES_RAW, ["source_row"])


def eligible_batches(raw: DataFrame) -> DataFrame:
    return raw.filter(predicates.not_test_batch_any_case(F.col("batch_name")))


def upsert_batches(raw: DataFrame, target: DataFrame | None = None, assume_zone: str = "UTC") -> DataFrame:
    """Typed batches of the eligible raw rows; the last row of a (bundle, batch) wins."""
    rows = eligible_batches(raw).select(
        clean.safe_bigint("bundle_id").alias("bundle_id"), clean.safe_bigint("batch_id").alias("batch_id"),
        "source_row",
        *[clean.clean_text(c).alias(c) for c in ("bundle_name", "batch_name", "batch_status", "tutor_name")],
        *[clean.parse_timestamp(c, zone=assume_zone).alias(c) for c in ("start_date", "end_date")],
        clean.safe_bigint("tutor_id").alias("tutor_id"),
        clean.safe_int("admitted_students", commas=True).try_cast("int").alias("admitted_students"),
    )
    return _upsert(rows, target, COURSE_BATCHES, ["source_row"])


# --- master tables ---------------------------------------------------------

def as_date(df: DataFrame, name: str, zone: str) -> Column:
    """Date of a column; only instants are read in ``zone``."""
    if df.schema[name].dataType.typeName() == "timestamp":
        return clean.local_date(name, zone)
    return F.col(name).cast("date")


def without_batches(catalogue: DataFrame, batches: DataFrame) -> DataFrame:
    """Catalogue courses that no given batch belongs to."""
    return catalogue.join(batches.select("bundle_id"), "bundle_id", "left_anti")


# Columns of the master tables.
_MERGE_TRAITS = (
    "course_division type subject level language sss_category adhyayanam_category personas position_in_funnel "
    "term_of_course texts certificate course_sponsor number_of_lectures duration").split()


def batch_merge(batches: DataFrame, catalogue: DataFrame, zone: str = "UTC") -> DataFrame:
    """Course/batch merge: ranked batches with course traits, plus courses without batches.

    Test batches leave before the ranking, which goes by start date.  The newest
    batch carries the course's status, older ones count as completed.
    """
    real = batches.filter(predicates.not_test_batch(F.col("batch_name")))
    ranked = latest_flag(real, "bundle_id", ["start_date", "batch_id"], "is_latest_batch")
    course = catalogue.select(
        "bundle_id", F.col("status").alias("catalogue_status"), F.col("num_students").alias("bundle_enrollment_count"),
        *_MERGE_TRAITS, "course_ids")
    newest = F.col("is_latest_batch") == 1
    counted = newest & F.col("catalogue_status").isin(*predicates.VALID_STATUSES)
    with_batches = ranked.join(course, "bundle_id", "left").select(
        "bundle_id", "bundle_name", "batch_id", "batch_name",
        F.when(newest, F.col("catalogue_status")).otherwise(F.lit("Completed")).alias("final_status"),
        "catalogue_status", "is_latest_batch", flag(counted).alias("include_in_course_count"),
        F.lit("").alias("status_adjustment_reason"), F.col("catalogue_status").alias("status"), "batch_status",
        F.lit(1).alias("has_batch"), as_date(ranked, "start_date", zone).alias("start_date"),
        as_date(ranked, "end_date", zone).alias("end_date"),
        F.col("admitted_students").alias("batch_enrollment_count"), "bundle_enrollment_count",
        "tutor_name", "tutor_id", *_MERGE_TRAITS, F.lit("").alias("computer_based_assessment"), "course_ids",
    )
    padded = without_batches(catalogue, real).select(
        "bundle_id", F.col("course_name").alias("bundle_name"), F.col("status").alias("final_status"),
        F.col("status").alias("catalogue_status"), F.lit(1).alias("is_latest_batch"),
        F.lit(0).alias("include_in_course_count"), F.lit("").alias("status_adjustment_reason"), "status",
        F.lit(0).alias("has_batch"), F.lit(0).alias("batch_enrollment_count"),
        F.col("num_students").alias("bundle_enrollment_count"), *_MERGE_TRAITS,
        F.lit("").alias("computer_based_assessment"), "course_ids",
    )
    return with_batches.unionByName(padded, allowMissingColumns=True)


_MASTER_TRAITS = (
    "course_name subject course_type term_of_course position_in_funnel adhyayanam_category sss_category viniyoga "
    "division").split()


def master(batches: DataFrame, catalogue: DataFrame, zone: str = "UTC") -> DataFrame:
    """Course master: all batches, the latest one by end date, plus courses without batches."""
    ranked = latest_flag(batches, "bundle_id", ["end_date", "batch_id"], "is_latest_batch")
    keyed = F.col("bundle_id").isNotNull() & F.col("batch_id").isNotNull()
    ranked = ranked.withColumn("is_latest_batch", F.when(keyed, F.col("is_latest_batch")).otherwise(0))
    course = catalogue.select("bundle_id", *_MASTER_TRAITS, "course_division", F.col("status").alias("catalogue_status"))
    counted = (
        (F.col("course_division") == "Course") & F.col("bundle_id").isNotNull()
        & F.col("catalogue_status").isin(*predicates.VALID_STATUSES))
    with_batches = ranked.join(course, "bundle_id", "left").select(
        "bundle_id", "bundle_name", "batch_id", "batch_name", "batch_status",
        as_date(ranked, "start_date", zone).alias("start_date"), as_date(ranked, "end_date", zone).alias("end_date"),
        "tutor_name", "admitted_students", *_MASTER_TRAITS, "catalogue_status",
        F.col("catalogue_status").alias("final_status"), "is_latest_batch",
        flag(counted).alias("include_in_course_count"), F.lit("").alias("status_adjustment_reason"),
        F.when(F.col("bundle_id").isNotNull(), 1).otherwise(0).alias("has_batch"),
    )
    padded = without_batches(catalogue, batches).select(
        "bundle_id", *_MASTER_TRAITS, F.col("status").alias("catalogue_status"), F.col("status").alias("final_status"),
        F.lit(0).alias("is_latest_batch"), F.lit(0).alias("include_in_course_count"),
        F.lit("").alias("status_adjustment_reason"), F.lit(0).alias("has_batch"),
    )
    return with_batches.unionByName(padded, allowMissingColumns=True)
