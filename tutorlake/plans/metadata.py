"""Course metadata: the merge table widened by the lifecycle tracker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import clean

# Output column -> raw tracker column.
TRACKER_TEXTS = {
    "classes_per_week": "no_of_classes_in_a_week",
    "class_days": "days_of_classes",
    "class_timings": "class_timings_ist",
    "additional_teacher": "additional_teacher_name_link",
    "ela": "ela",
    "employee_id": "employee_id",
    "panelists": "panelists",
    "assessment_type": "type_of_assessment",
}
TRACKER_DATES = {
    "launch_date": "course_launch_date",
    "first_class_date": "first_class_date",
    "last_class_date": "last_class_and_valedictory_date",
    "assessment_start_date": "assessment_start_date",
    "assessment_end_date": "assessment_end_date",
}
TRACKER_COUNTS = {
    "enrollments_after_launch": "enrolments_on_next_day_of_launch",
    "enrollments_on_first_class": "enrolments_on_the_day_of_first_class",
    "first_class_attendance": "first_class_attendance",
    "second_class_attendance": "second_class_attendance",
    "enrollments_on_last_day": "enrolments_on_last_day",
    "last_class_attendance": "last_class_attendance",
    "total_classes_held": "total_no_of_classes_held",
    "total_assessment_attendees": "total_assessment_attendees",
    "total_certified": "total_students_certified",
}
TRACKER_NUMBERS = {
    "total_class_hours": "total_hours_of_classes",
    "avg_attendance": "average_attendance_of_all_classes",
    "overall_rating": "overall_course_rating",
    "avg_rating_ease": "average_rating_for_ease_of_attending_live_webinars",
    "avg_rating_quality": "average_rating_for_quality_of_content_and_course_materials",
    "avg_teacher_rating": "average_teacher_rating",
    "avg_rating_access": "average_rating_for_accessing_course_materials_in_the_website",
    "avg_ela_rating": "average_ela_rating_by_teacher",
    "avg_content_support_rating": "average_content_support_rating_by_teacher",
}
RATIOS = {
    "cert_vs_initial_enroll": ("total_certified", "enrollments_on_first_class"),
    "cert_vs_end_enroll": ("total_certified", "enrollments_on_last_day"),
    "cert_vs_first_class_attend": ("total_certified", "first_class_attendance"),
    "cert_vs_avg_attend": ("total_certified", "avg_attendance"),
    "first_class_attend_vs_initial": ("first_class_attendance", "enrollments_on_first_class"),
    "first_class_attend_vs_last": ("first_class_attendance", "last_class_attendance"),
    "pass_pct_cert_vs_attendees": ("total_certified", "total_assessment_attendees"),
    "pass_pct_students_vs_cert": ("enrollments_on_last_day", "total_certified"),
}
_MERGE_COLUMNS = (
    "bundle_id batch_id start_date end_date num_students tutors tutor_ids course_ids subject level language texts "
    "type course_division certificate course_sponsor status number_of_lectures duration personas sss_category "
    "adhyayanam_category term_of_course position_in_funnel is_latest_batch include_in_course_count has_batch").split()


def tracker(raw: DataFrame) -> DataFrame:
    """Typed tracker rows, one per (course, batch name): the first raw row counts."""
    def raw_text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    typed = raw.select(
        clean.safe_int("course_id", commas=True).alias("bundle_id"),
        clean.clean_text("batch_name").alias("batch_name"), "source_row",
        clean.clean_text(raw_text("course_name")).alias("course_name"),
        *[clean.clean_text(raw_text(src)).alias(name) for name, src in TRACKER_TEXTS.items()],
        *[clean.parse_date(raw_text(src), clean.LIFECYCLE_DATE_FORMATS).alias(name)
          for name, src in TRACKER_DATES.items()],
        *[clean.safe_int(raw_text(src), commas=True).try_cast("int").alias(name) for name, src in TRACKER_COUNTS.items()],
        *[clean.safe_float(raw_text(src)).try_cast("decimal(8,2)").alias(name)
          for name, src in TRACKER_NUMBERS.items()],
    ).filter(F.col("bundle_id").isNotNull() & F.col("batch_name").isNotNull())
    row = F.struct(*[c for c in typed.columns if c not in ("bundle_id", "batch_name", "source_row")])
    return typed.groupBy("bundle_id", "batch_name").agg(F.min_by(row, "source_row").alias("row")).select(
        "bundle_id", "batch_name", "row.*")


def ratio(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals, NULL when there is nothing to divide by."""
    exact = part.cast("decimal(12,2)") * F.lit(100).cast("decimal(3,0)")
    return F.round(exact / F.nullif(whole.cast("decimal(12,2)"), F.lit(0).cast("decimal(12,2)")), 2).cast("decimal(18,2)")


def course_metadata(merged: DataFrame, raw_tracker: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Merge table left-joined with the tracker on course and batch name, plus guarded ratios and the load time."""
    traits = merged.select(
        *[c for c in _MERGE_COLUMNS if c not in ("num_students", "tutors", "tutor_ids")],
        F.col("bundle_name"), F.col("batch_name"),
        F.col("batch_enrollment_count").alias("admitted_students"),
        F.col("bundle_enrollment_count").alias("num_students"),
        F.col("tutor_name").alias("tutors"), F.col("tutor_id").cast("string").alias("tutor_ids"),
    )
    joined = traits.join(tracker(raw_tracker), ["bundle_id", "batch_name"], "left")
    return joined.select(
        "bundle_id", F.coalesce("course_name", "bundle_name").alias("course_name"), "batch_name", "admitted_students",
        *[c for c in _MERGE_COLUMNS if c != "bundle_id"],
        *TRACKER_TEXTS, *TRACKER_DATES, *TRACKER_COUNTS, *TRACKER_NUMBERS,
        *[ratio(F.col(part), F.col(whole)).alias(name) for name, (part, whole) in RATIOS.items()],
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )
