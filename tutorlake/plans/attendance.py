"""Attendance: landed rows, per-class summaries, class numbers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import clean
from tutorlake.functions.jsonfields import first_truthy, staged, texts_of
from tutorlake.operators import predicates, upsert
from tutorlake.operators.policies import ATTENDANCE_RAW, CLASS_ATTENDANCE
from tutorlake.operators.ranking import number_by_day
from tutorlake.session import stored

# Names of the reply's fields.
_IDS = {
    "student_id": ("student_Id", "student_id"),
    "batch_id": ("batch_Id", "batch_id"),
    "class_id": ("class_Id", "class_id"),
    "bundle_id": ("bundle_Id", "bundle_id"),
    "course_id": ("course_Id", "course_id"),
    "teacher_id": ("teacher_Id", "teacher_id"),
}
_TEXTS = {
    "student_name": "studentName",
    "reg_no": "regNo",
    "student_contact": "studentContact",
    "student_batch_status": "studentBatchStatus",
    "batch_name": "batchName",
    "class_name": "className",
    "bundle_name": "bundleName",
    "course_name": "courseName",
    "session_name": "sessionName",
    "teacher_name": "teacherName",
    "teacher_email": "teacherEmail",
    "teacher_class_signin_status": "teacherClassSigninStatus",
    "attendance_status": "studentAttendanceStatus",
    "class_date": "classDate",
    "start_time": "startTime",
    "end_time": "endTime",
    "class_duration": "classDuration",
    "student_comments": "studentComments",
}


def landed_rows(rows: DataFrame, staff_token: str = predicates.STAFF_TOKEN) -> DataFrame:
    """Typed attendance rows from API rows (``row`` VARIANT, ``pull_date``, ``seq``).

    ``is_staff`` marks the rows that ingestion skips.
    """
    row, texts = F.col("row"), F.col("__texts")
    email = F.coalesce(texts["studentEmail"], texts["student_email"])
    return staged(rows, __texts=texts_of(row)).select(
        "pull_date", "seq",
        *[clean.safe_int(first_truthy(row, *names, texts=texts)).alias(name) for name, names in _IDS.items()],
        clean.safe_int(texts["attendance_id"]).alias("attendance_id"),
        clean.safe_int(texts["studentRating"]).try_cast("int").alias("student_rating"),
        email.alias("student_email"),
        *[texts[key].alias(name) for name, key in _TEXTS.items()],
        clean.parse_date(texts["classDate"]).alias("class_date_parsed"),
        F.to_json(row).alias("raw_payload"),
        predicates.staff_at_ingest(email, staff_token).alias("is_staff"),
    )


def upsert_raw(rows: DataFrame, target: DataFrame | None = None, met: DataFrame | None = None) -> DataFrame:
    """One row per (student, class): later pulls refresh the status columns.

    A whole range of pull dates is one fold, ordered by pull date and position.  ``met``, where it is known, holds the
    keys that have several rows or a stored one.
    """
    rule = ATTENDANCE_RAW
    present = [c for c in rows.columns if c in rule.policies]
    policies = {c: p for c, p in rule.policies.items() if c in present}
    changes = rows.withColumn("__pull", F.col("pull_date"))
    seq = ["__pull", "seq"]
    if met is not None:
        return upsert.apply_where_met(target, changes, rule.keys, seq, policies, met)
    if target is None:
        return upsert.fold(changes, rule.keys, seq, policies)
    return upsert.apply(target, changes, rule.keys, seq, policies)


def percentage(part: Column, total: Column) -> Column:
    """``part`` in percent of ``total``, two decimals half up, NULL for an empty total."""
    exact = part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(exact / F.nullif(total, F.lit(0)).cast("decimal(12,0)"), 2)


def average(total: Column, count: Column, kind: str = "decimal(8,2)") -> Column:
    """Mean of two-decimal values from their sum and count, half up."""
    exact = total.cast("decimal(20,2)") / F.nullif(count, F.lit(0)).cast("decimal(12,0)")
    return F.round(exact, 2).cast(kind)


def summarise(raw: DataFrame, late_counts: bool = False, by_pull: bool = True) -> DataFrame:
    """Per class: present, late and absent students and the attendance rate.

    Only statuses P, L and A of rows with batch and class count.  With
    ``late_counts`` late students count as present in the rate.  With
    ``by_pull`` each pull date is summarised on its own.
    """
    status = F.col("attendance_status")
    eligible = raw.filter(
        F.col("batch_id").isNotNull() & F.col("class_id").isNotNull()
        & status.isin(*predicates.COUNTED_ATTENDANCE))
    keys = ["batch_id", "class_id", "bundle_id"] + (["pull_date"] if by_pull else [])
    names = ["batch_name", "bundle_name", "attendance_id", "teacher_id", "teacher_name", "class_duration"]
    counted = eligible.groupBy(*keys).agg(
        *[F.min(name).alias(name) for name in names],
        F.min("class_date_parsed").alias("class_date"),
        F.count_if(status == "P").alias("present_count"),
        F.count_if(status == "L").alias("late_count"),
        F.count_if(status == "A").alias("absent_count"),
        F.count("*").alias("total_records"),
        *([] if by_pull else [F.max("pull_date").alias("pull_date")]),
    )
    attended = F.col("present_count") + (F.col("late_count") if late_counts else F.lit(0))
    counts = ["present_count", "late_count", "absent_count", "total_records"]
    return counted.select(
        "batch_id", "batch_name", "class_id", "bundle_id", "bundle_name", "class_date",
        *[F.col(c).cast("int").alias(c) for c in counts],
        percentage(attended, F.col("total_records")).cast("decimal(5,2)").alias("attendance_pct"),
        "attendance_id", "teacher_id", "teacher_name", "class_duration", "pull_date",
    )


def research_summary(raw: DataFrame) -> DataFrame:
    """Per pull, batch and class: every status counts in the total, labels of the first row.

    The class date is the pull date; the status is compared without case and
    outer blanks.
    """
    status = F.upper(clean.strip("attendance_status"))
    labels = ["batch_name", "bundle_id", "bundle_name", "attendance_id", "teacher_id", "teacher_name",
              "class_duration"]
    counted = (
        raw.filter(F.col("batch_id").isNotNull() & F.col("class_id").isNotNull())
        .groupBy("pull_date", "batch_id", "class_id")
        .agg(
            F.min_by(F.struct(*labels), F.col("seq")).alias("first"),
            F.count_if(status == "P").alias("present_count"),
            F.count_if(status == "L").alias("late_count"),
            F.count_if(status == "A").alias("absent_count"),
            F.count("*").alias("total_records"),
        )
    )
    return counted.select(
        "batch_id", "class_id", "first.*", F.col("pull_date").alias("class_date"), "pull_date",
        "present_count", "late_count", "absent_count", "total_records",
        percentage(F.col("present_count"), F.col("total_records")).cast("decimal(5,2)").alias("attendance_pct"),
    )


def one_bundle_per_class(summary: DataFrame) -> DataFrame:
    """Two bundles for one class of one pull: the smaller bundle id stays.

    ``bundle_conflicts`` reports how many summaries competed.
    """
    keys = ["batch_id", "class_id", "pull_date"]
    row = F.struct("bundle_id", *[c for c in summary.columns if c not in (*keys, "bundle_id")])
    picked = summary.groupBy(*keys).agg(
        F.min_by(row, F.struct(F.col("bundle_id").isNull(), "bundle_id")).alias("row"),
        (F.count("*") - 1).alias("bundle_conflicts"))
    return picked.select(*keys, "row.*", "bundle_conflicts")


def upsert_classes(summary: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """One row per (batch, class): the latest pull wins, the first bundle stays."""
    rule = CLASS_ATTENDANCE
    changes = one_bundle_per_class(summary).withColumn("__pull", F.col("pull_date"))
    if target is None:
        return upsert.fold(changes, rule.keys, ["__pull"], rule.policies)
    return upsert.apply(target, changes, rule.keys, ["__pull"], rule.policies)


def number_classes(classes: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Number the classes of each batch by date; ties by class id.

    With ``touched`` (a DataFrame holding ``batch_id``) only those batches are
    renumbered and all others keep the number they have.
    """
    if touched is None:
        return number_by_day(classes, "batch_id", "class_date", "class_id", "class_number")
    batches = touched.select("batch_id").distinct()
    renumbered = number_by_day(
        classes.join(batches, "batch_id", "left_semi"), "batch_id", "class_date", "class_id", "class_number")
    return renumbered.unionByName(classes.join(batches, "batch_id", "left_anti"))


@dataclass(frozen=True)
class Loaded:
    """The tables after a pull, and what the pull brought."""
    bronze: DataFrame
    classes: DataFrame
    metrics: DataFrame


def load_pull(rows: DataFrame, loaded_at: Column, bronze: DataFrame | None = None, classes: DataFrame | None = None,
              late_counts: bool = False) -> Loaded:
    """One pull date's rows (with ``is_staff``) through all tables.

    Raw rows are merged into ``bronze``; the bronze rows of that date are summarised per class and merged into
    ``classes``; the batches of that date get their classes numbered anew.  Loading a pull again changes nothing but
    ``loaded_at``.
    """
    saved = rows.filter(~F.col("is_staff")).drop("is_staff").withColumn("loaded_at", loaded_at)
    bronze = stored(upsert_raw(saved, bronze), "attendance-bronze")
    mine = bronze.join(saved.select("pull_date").distinct(), "pull_date", "left_semi")
    summary = summarise(mine, late_counts)
    if classes is None:
        merged = upsert_classes(summary).withColumn("class_number", F.lit(None).cast("int"))
    else:
        merged = upsert_classes(summary, classes)
    numbered = number_classes(stored(merged, "attendance-classes"), mine)
    return Loaded(bronze, numbered, ingest_metrics(rows))


def ingest_metrics(rows: DataFrame, totals: bool = True) -> DataFrame:
    """Per pull date (and overall, with a NULL date): received, saved, skipped staff, silver rows."""
    silver_row = F.when(
        ~F.col("is_staff") & F.col("batch_id").isNotNull() & F.col("class_id").isNotNull()
        & F.col("attendance_status").isin(*predicates.COUNTED_ATTENDANCE),
        F.struct("batch_id", "class_id", F.col("bundle_id")))
    # One row per (date, silver row) first: no distinct set is built for a date.
    per_row = rows.groupBy("pull_date", silver_row.alias("silver_row")).agg(
        F.count("*").alias("n"), F.count_if("is_staff").alias("staff"))
    per_date = per_row.groupBy("pull_date").agg(
        F.sum("n").alias("received"),
        (F.sum("n") - F.sum("staff")).alias("saved"),
        F.sum("staff").alias("skipped_staff"),
        F.count("silver_row").alias("silver_rows"),
    )
    if not totals:
        return per_date
    measures = [c for c in per_date.columns if c != "pull_date"]
    return per_date.rollup("pull_date").agg(*[F.sum(c).alias(c) for c in measures])


def summary_export(summary: DataFrame, loaded_at: Column) -> DataFrame:
    """Columns of the daily summary file, in their order."""
    names: Iterable[str] = (
        "batch_id batch_name class_id bundle_id bundle_name class_date present_count late_count absent_count "
        "total_records attendance_pct attendance_id teacher_id teacher_name class_duration pull_date").split()
    return summary.select(*names, loaded_at.alias("loaded_at"))
