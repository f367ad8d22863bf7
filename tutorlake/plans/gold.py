"""The thirteen reporting views.

Each view is a function from the silver tables to a DataFrame.  Facts are
aggregated to their reporting key before they meet a dimension, so the joins
carry one row per course or batch instead of one per enrolment or class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tutorlake.functions.labels import learning_model as learning_model_label
from tutorlake.operators.predicates import STAFF_PATTERN, not_staff
from tutorlake.plans.attendance import average, percentage
from tutorlake.plans.courses import as_date

LIVE_SOURCE = "webhook"
HISTORICAL_SOURCE = "csv.import"


# --- attendance ------------------------------------------------------------

def _per_batch(classes: DataFrame) -> DataFrame:
    """One row per (batch, bundle) with the measures of both batch views.

    The last class is the one with the batch's highest number, whatever bundle
    it belongs to; among classes sharing that number the fullest counts.
    """
    number, present = F.col("class_number").cast("bigint"), F.col("present_count")
    # Class number and attendance in one number: its maximum is found by hashing, that of a struct by sorting.
    packed = F.shiftleft(number, 32) + F.coalesce(present + 1, F.lit(0))
    measures = classes.groupBy("batch_id", "bundle_id").agg(
        F.count("*").alias("classes"),
        F.sum("attendance_pct").alias("pct_sum"),
        F.count("attendance_pct").alias("pct_count"),
        F.min("class_date").alias("first_class_date"),
        F.max("class_date").alias("last_class_date"),
        F.max("class_number").alias("total_class_count"),
        F.max(F.when(number == 1, present)).alias("first_present"),
        F.max(packed).alias("last"),
    )
    # The batch's highest number is the highest over its bundles, of which there are few.
    top = F.max("total_class_count").over(Window.partitionBy("batch_id"))
    last_present = F.nullif(F.col("last").bitwiseAND((1 << 32) - 1), F.lit(0)) - 1
    return measures.withColumn("top_number", top).withColumn(
        "last_present", F.when(F.col("total_class_count") == F.col("top_number"), last_present.cast("int")),
    ).drop("last", "top_number")


def _with_dimensions(per_batch: DataFrame, catalogue: DataFrame, batch_dimension: DataFrame) -> DataFrame:
    return per_batch.join(catalogue.select("bundle_id", "course_name"), "bundle_id", "left").join(
        batch_dimension, "batch_id", "left")


def batch_attendance(classes: DataFrame, catalogue: DataFrame, batches: DataFrame, zone: str = "UTC") -> DataFrame:
    """Per batch: classes held, average rate, first and last class.

    Batches are looked up by batch id alone.  A batch listed several times with
    equal details multiplies the class count, as a join before the grouping would.
    """
    dimension = batches.groupBy("batch_id", "batch_name", "tutor_name", "start_date", "end_date", "admitted_students").agg(
        F.count("*").alias("copies"))
    joined = _with_dimensions(_per_batch(classes), catalogue, dimension)
    return joined.select(
        "batch_id", "bundle_id", "course_name", "batch_name", "tutor_name",
        as_date(joined, "start_date", zone).alias("batch_start_date"),
        as_date(joined, "end_date", zone).alias("batch_end_date"),
        F.col("admitted_students").alias("students_enrolled_count"),
        (F.col("classes") * F.coalesce("copies", F.lit(1))).alias("total_classes_held"),
        average(F.col("pct_sum"), F.col("pct_count")).alias("average_attendance_percentage"),
        "first_class_date", "last_class_date", "total_class_count",
        F.col("first_present").alias("first_class_present_count"),
        F.col("last_present").alias("last_class_present_count"),
    )


def bundle_attendance(batch_view: DataFrame) -> DataFrame:
    """Per course over :func:`batch_attendance`."""
    return batch_view.groupBy("bundle_id", "course_name").agg(
        F.countDistinct("batch_id").alias("total_batches_count"),
        F.sum("total_classes_held").alias("total_classes_all_batches"),
        average(F.sum("average_attendance_percentage"), F.count("average_attendance_percentage"))
        .alias("overall_average_attendance"),
        F.sum("students_enrolled_count").alias("total_enrolled_all_batches"),
        F.min("first_class_date").alias("earliest_class_date"),
        F.max("last_class_date").alias("latest_class_date"),
    )


def attendance_by_year(classes: DataFrame) -> DataFrame:
    """Per calendar year; ordered by year.

    Classes are first reduced to (year, batch, bundle), so the two distinct
    counts expand those rows and not the classes.
    """
    reduced = classes.groupBy(F.year("class_date").alias("attendance_year"), "batch_id", "bundle_id").agg(
        F.count("*").alias("classes"), F.sum("attendance_pct").alias("pct_sum"),
        F.count("attendance_pct").alias("pct_count"), F.sum("present_count").alias("present"))
    return reduced.groupBy("attendance_year").agg(
        F.countDistinct("batch_id").alias("active_batches_count"),
        F.countDistinct("bundle_id").alias("active_courses_count"),
        F.sum("classes").alias("total_classes_count"),
        average(F.sum("pct_sum"), F.sum("pct_count")).alias("average_attendance_percentage"),
        F.sum("present").alias("total_students_attended_count"),
    ).orderBy("attendance_year")


def first_vs_last_class(classes: DataFrame, catalogue: DataFrame, batches: DataFrame) -> DataFrame:
    """Per batch: students in the first and last class and the drop-off in percent of those enrolled."""
    dimension = batches.select("batch_id", "batch_name", "admitted_students").distinct()
    joined = _with_dimensions(_per_batch(classes), catalogue, dimension)
    lost = F.col("first_present") - F.col("last_present")
    return joined.select(
        "batch_id", "bundle_id", "course_name", "batch_name",
        F.col("first_present").alias("first_class_student_count"),
        F.col("last_present").alias("last_class_student_count"),
        F.col("admitted_students").alias("total_students_enrolled"),
        percentage(lost, F.col("admitted_students")).cast("decimal(12,2)").alias("student_drop_off_percentage"),
    )


# --- courses and learners --------------------------------------------------

# Columns of the course views.
_COURSE_TRAITS = (
    "course_name course_type status subject term_of_course position_in_funnel adhyayanam_category sss_category "
    "viniyoga division").split()
_LIFECYCLE_MEASURES = {
    "type_of_launch": "type_of_launch",
    "first_class_date": "first_class_date",
    "last_class_date": "last_class_date",
    "enrollments_on_fc": "enrollments_on_first_class",
    "enrollments_on_lc": "enrollments_on_last_class",
    "avg_attendance": "average_attendance",
    "total_certified": "total_students_certified",
    "overall_rating": "overall_rating",
}


def _count_users(transactions: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Distinct users per course, overall and where a flag holds for any of their rows.

    First one row per (course, user), then one per course: both steps combine on
    the map side and neither builds a set, so a course with a third of all
    enrolments is spread by user.
    """
    per_user = transactions.filter(F.col("user_id").isNotNull()).groupBy("bundle_id", "user_id").agg(
        *[F.max(F.when(condition, 1)).alias(name) for name, condition in flags.items()])
    return per_user.groupBy("bundle_id").agg(
        F.count("*").alias("total"), *[F.count(name).alias(name) for name in flags])


def course(catalogue: DataFrame, lifecycle: DataFrame, transactions: DataFrame, staff_pattern: str = STAFF_PATTERN,
           historical_source: str = HISTORICAL_SOURCE) -> DataFrame:
    """Per catalogue course and lifecycle row: traits, measures and distinct non-staff learners.

    Courses without enrolments stay with zero counts.
    """
    learners = _count_users(
        transactions.filter(not_staff("email", staff_pattern)),
        {"live": F.col("source") == LIVE_SOURCE, "historical": F.col("source") == historical_source})
    stages = lifecycle.select(
        F.col("course_id").alias("bundle_id"),
        *[F.col(src).alias(name) for src, name in _LIFECYCLE_MEASURES.items()])
    described = catalogue.select("bundle_id", *_COURSE_TRAITS).join(stages, "bundle_id", "left").distinct()
    return described.join(learners, "bundle_id", "left").select(
        *described.columns,
        F.coalesce("total", F.lit(0)).alias("total_enrollments_count"),
        F.coalesce("live", F.lit(0)).alias("live_enrollments_count"),
        F.coalesce("historical", F.lit(0)).alias("historical_enrollments_count"),
    )


def learner(transactions: DataFrame, catalogue: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    """Per course: all learners, those on their first-ever start date, those who started elsewhere before.

    Rows without a start date count in the total only.
    """
    students = transactions.filter(not_staff("email", staff_pattern) & F.col("user_id").isNotNull())
    per_user = students.groupBy("bundle_id", "user_id").agg(
        F.min("start_date").alias("earliest"), F.max("start_date").alias("latest"))
    # One row per course and user is left, so a user's window holds at most as many rows as there are courses.
    per_user = per_user.withColumn("first_ever", F.min("earliest").over(Window.partitionBy("user_id")))
    counted = per_user.groupBy("bundle_id").agg(
        F.count("*").alias("total_learners_count"),
        F.count_if(F.col("earliest") == F.col("first_ever")).alias("new_learners_count"),
        F.count_if(F.col("latest") > F.col("first_ever")).alias("returning_learners_count"),
    )
    traits = catalogue.select("bundle_id", "course_name", "course_type", "position_in_funnel")
    return counted.join(traits, "bundle_id", "left").select(*traits.columns, *[c for c in counted.columns if c != "bundle_id"])


def _course_sums(view: DataFrame, *keys: Column | str, measures: tuple[str, ...]) -> DataFrame:
    sums = {
        "total_enrollments_sum": "total_enrollments_count",
        "total_enrollments_on_first_class": "enrollments_on_first_class",
        "total_enrollments_on_last_class": "enrollments_on_last_class",
    }
    return view.groupBy(*keys).agg(
        F.countDistinct("bundle_id").alias("total_courses_count"),
        *[F.sum(sums[name]).alias(name) for name in measures])


_ALL_SUMS = ("total_enrollments_sum", "total_enrollments_on_first_class", "total_enrollments_on_last_class")


def course_type(course_view: DataFrame) -> DataFrame:
    return _course_sums(course_view, "course_type", "status", measures=_ALL_SUMS)


def launch_type(course_view: DataFrame) -> DataFrame:
    known = course_view.filter(F.col("type_of_launch").isNotNull())
    return _course_sums(known, "type_of_launch", measures=_ALL_SUMS[:1])


def subject(course_view: DataFrame) -> DataFrame:
    known = course_view.filter(F.col("subject").isNotNull())
    return _course_sums(known, "subject", "status", measures=_ALL_SUMS)


def learning_model(course_view: DataFrame) -> DataFrame:
    label = learning_model_label(F.col("viniyoga"), F.col("adhyayanam_category")).alias("learning_model_name")
    return _course_sums(course_view, label, measures=_ALL_SUMS[:1])


def _learner_sums(course_view: DataFrame, learner_view: DataFrame, key: str) -> DataFrame:
    learners = learner_view.select("bundle_id", "new_learners_count", "returning_learners_count")
    joined = course_view.select("bundle_id", key, "total_enrollments_count").join(learners, "bundle_id", "left")
    new, returning = F.sum("new_learners_count"), F.sum("returning_learners_count")
    return joined.groupBy(key).agg(
        F.countDistinct("bundle_id").alias("total_courses_count"),
        F.sum("total_enrollments_count").alias("total_enrollments_sum"),
        new.alias("total_new_learners"),
        returning.alias("total_returning_learners"),
        (new + returning).alias("total_individual_learner_count"),
    )


def term(course_view: DataFrame, learner_view: DataFrame) -> DataFrame:
    return _learner_sums(course_view, learner_view, "term_of_course")


def funnel(course_view: DataFrame, learner_view: DataFrame) -> DataFrame:
    return _learner_sums(course_view, learner_view, "position_in_funnel")


def sss_domain(course_view: DataFrame, learner_view: DataFrame) -> DataFrame:
    return _learner_sums(course_view.filter(F.col("sss_category").isNotNull()), learner_view, "sss_category")


VIEWS_OVER_COURSE = {
    "course_type": course_type, "launch_type": launch_type, "subject": subject, "learning_model": learning_model,
}
VIEWS_OVER_COURSE_AND_LEARNER = {"term": term, "funnel": funnel, "sss_domain": sss_domain}


def register_views(spark, tables: dict[str, DataFrame], prefix: str = "gold_", zone: str = "UTC",
                   staff_pattern: str = STAFF_PATTERN, historical_source: str = HISTORICAL_SOURCE) -> list[str]:
    """Register all views as temporary views over the given silver tables.

    ``tables`` holds ``course_catalogue``, ``course_lifecycle``, ``transactions``,
    ``course_batches`` and ``class_attendance``.
    """
    catalogue, batches, classes = (tables[n] for n in ("course_catalogue", "course_batches", "class_attendance"))
    views = {
        "course": course(catalogue, tables["course_lifecycle"], tables["transactions"], staff_pattern, historical_source),
        "learner": learner(tables["transactions"], catalogue, staff_pattern),
        "batch_attendance": batch_attendance(classes, catalogue, batches, zone),
        "attendance_by_year": attendance_by_year(classes),
        "first_vs_last_class": first_vs_last_class(classes, catalogue, batches),
    }
    views["bundle_attendance"] = bundle_attendance(views["batch_attendance"])
    for name, build in VIEWS_OVER_COURSE.items():
        views[name] = build(views["course"])
    for name, build in VIEWS_OVER_COURSE_AND_LEARNER.items():
        views[name] = build(views["course"], views["learner"])
    for name, view in views.items():
        view.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
