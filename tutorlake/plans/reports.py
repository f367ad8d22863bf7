"""The ten report sections as one long table: section, metric, label, value.

Enrolments feed four sections.  They are read once: grouped to a small cube
first, then rolled out to every breakdown with grouping sets.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import labels
from tutorlake.operators.predicates import STAFF_PATTERN, not_staff
from tutorlake.plans.courses import as_date
from tutorlake.session import stored

VALUE = "decimal(24,6)"
TOP = 5


def _rows(df: DataFrame, section: int, metric: str, value: Column, label: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), F.lit(metric).alias("metric"),
        (F.lit(None) if label is None else label).cast("string").alias("label"),
        value.cast(VALUE).alias("value"))


def _count(df: DataFrame, section: int, metric: str) -> DataFrame:
    return _rows(df.agg(F.count("*").alias("n")), section, metric, F.col("n"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def breakdown(df: DataFrame, key: Column, top: int | None = None) -> DataFrame:
    """Rows per label, largest first, ties by label; NULL reads ``(not set)``."""
    counted = df.groupBy(labels.or_not_set(key).alias("label")).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), "label")
    return ordered.limit(top) if top else ordered


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table, ordered by name."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in sorted(tables.items())]
    return union_all(parts).select("table_name", F.col("n").alias("row_count")).orderBy("table_name")


def data_health(tables: Mapping[str, DataFrame], events: DataFrame | None = None) -> DataFrame:
    """Rows of each table and, with the events, when the last one arrived."""
    parts = [_rows(row_counts(tables), 1, "rows", F.col("row_count"), F.col("table_name"))] if tables else []
    if events is not None:
        parts.append(_rows(events.agg(F.max("received_epoch").alias("latest")), 1, "last event received", F.col("latest")))
    return union_all(parts)


def _in_total_and_by(df: DataFrame, label: Column, **measures: Column) -> DataFrame:
    """``n`` and the measures over all rows (``whole``) and per label, from one reading of the table."""
    labelled = df.withColumn("label", labels.or_not_set(label))
    aggregates = [F.count("*").alias("n"), *[value.alias(name) for name, value in measures.items()]]
    return labelled.groupingSets([[], ["label"]], "label").agg((F.grouping_id("label") == 1).alias("whole"), *aggregates)


def _metrics(rows: DataFrame, *metrics: Column) -> DataFrame:
    """Each metric that applies to a row as a row of its own."""
    return rows.select(F.explode(F.array(*metrics)).alias("m")).filter(F.col("m").isNotNull()).select("m.*")


def _table_rows(name: str, condition: Column | None = None) -> Column:
    return _metric(F.lit(True) if condition is None else condition, 1, "rows", F.col("n"), F.lit(name))


def catalogue_section(catalogue: DataFrame) -> DataFrame:
    whole, n = F.col("whole"), F.col("n")
    return _metrics(
        _in_total_and_by(catalogue, F.col("subject")), _table_rows("course_catalogue", whole), _metric(whole, 2, "courses", n),
        _metric(~whole, 2, "courses by subject", n, F.col("label")))


def active_batches(batches: DataFrame, as_of: date, zone: str = "UTC") -> DataFrame:
    """Batches that end on ``as_of`` or later."""
    return batches.filter(as_date(batches, "end_date", zone) >= F.lit(as_of))


def batch_section(batches: DataFrame, as_of: date, zone: str = "UTC") -> DataFrame:
    whole, n = F.col("whole"), F.col("n")
    active = F.count_if(as_date(batches, "end_date", zone) >= F.lit(as_of))
    return _metrics(
        _in_total_and_by(batches, F.col("batch_status"), active=active), _table_rows("course_batches", whole),
        _metric(whole, 3, "batches", n), _metric(~whole, 3, "batches by status", n, F.col("label")),
        _metric(whole, 3, "ongoing or future batches", F.col("active")))


def student_section(users: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    student = F.coalesce(not_staff("email", staff_pattern), F.lit(False))
    totals = users.agg(F.count("*").alias("n"), F.count_if(student).alias("students"))
    every = F.lit(True)
    return union_all([
        _metrics(totals, _table_rows("users"), _metric(every, 5, "registered users", F.col("n")),
                 _metric(every, 5, "students", F.col("students"))),
        _rows(breakdown(users.filter(student), F.col("state"), TOP), 5, "top states", F.col("n"), F.col("label")),
    ])


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean of two-decimal values, kept to six decimals."""
    return (total.cast("decimal(24,2)") / F.nullif(count, F.lit(0)).cast("decimal(12,0)")).cast(VALUE)


def attendance_section(classes: DataFrame) -> DataFrame:
    totals = classes.agg(
        F.count("*").alias("n"), F.sum("attendance_pct").alias("s"), F.count("attendance_pct").alias("c"))
    every = F.lit(True)
    return _metrics(totals, _table_rows("class_attendance"), _metric(every, 6, "class records", F.col("n")),
                    _metric(every, 6, "average attendance", mean(F.col("s"), F.col("c"))))


def assessment_section(assessments: DataFrame, certificates: DataFrame) -> DataFrame:
    counted = ((assessments, "assessments", "assessment events"), (certificates, "certificates", "certificates issued"))
    return union_all([
        _metrics(df.agg(F.count("*").alias("n")), _table_rows(name), _metric(F.lit(True), 7, metric, F.col("n")))
        for df, name, metric in counted])


def session_section(sessions: DataFrame) -> DataFrame:
    totals = sessions.agg(F.count("*").alias("n"), F.count("cancellation_reason").alias("cancelled"))
    every = F.lit(True)
    return _metrics(totals, _table_rows("sessions"), _metric(every, 9, "sessions", F.col("n")),
                    _metric(every, 9, "cancelled sessions", F.col("cancelled")))


_CUBE_KEYS = ("source", "year", "bundle_id", "course_name")


def _enrolment_cube(transactions: DataFrame, staff_pattern: str, zone: str = "UTC") -> DataFrame:
    """Non-staff enrolments per source, year and course; the only pass over the facts."""
    price = F.col("final_price")
    return (
        transactions.filter(not_staff("email", staff_pattern))
        .withColumn("year", F.year(as_date(transactions, "created_at", zone)))
        .groupBy(*_CUBE_KEYS)
        .agg(F.count("*").alias("n"), F.sum(price).alias("revenue"),
             F.sum(F.when(price > 0, price)).alias("paid"), F.count(F.when(price > 0, 1)).alias("paid_n"))
    )


def enrolment_breakdowns(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    """Counts and revenue in total and by source, year, course id and course name.

    ``level`` says which of these a row belongs to.
    """
    return _roll_out(_enrolment_cube(transactions, staff_pattern))


def _roll_out(cube: DataFrame) -> DataFrame:
    sets = [[], ["source"], ["year"], ["bundle_id"], ["course_name"]]
    rolled = cube.groupingSets(sets, *_CUBE_KEYS).agg(
        F.grouping_id(*_CUBE_KEYS).alias("grouping"),
        *[F.sum(c).alias(c) for c in ("n", "revenue", "paid", "paid_n")])
    level = (
        F.when(F.col("grouping") == 15, F.lit("total")).when(F.col("grouping") == 7, F.lit("source"))
        .when(F.col("grouping") == 11, F.lit("year")).when(F.col("grouping") == 13, F.lit("bundle_id"))
        .otherwise(F.lit("course_name")))
    return rolled.withColumn("level", level).drop("grouping")


def enrolments_by_source(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    return breakdown(transactions.filter(not_staff("email", staff_pattern)), F.col("source"))


def unique_students(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    return transactions.filter(not_staff("email", staff_pattern)).agg(F.countDistinct("user_id").alias("n"))


def revenue_by_year(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN, zone: str = "UTC") -> DataFrame:
    """Revenue per year of creation, unknown years together, in year order."""
    students = transactions.filter(not_staff("email", staff_pattern))
    return students.groupBy(F.year(as_date(transactions, "created_at", zone)).alias("year")).agg(F.sum("final_price").alias("revenue")).orderBy("year")


def average_paid(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    paid = transactions.filter(not_staff("email", staff_pattern) & (F.col("final_price") > 0))
    return paid.agg(mean(F.sum("final_price"), F.count("final_price")).alias("average_paid"), F.count("*").alias("n"))


def top_courses(transactions: DataFrame, catalogue: DataFrame, staff_pattern: str = STAFF_PATTERN,
                top: int = TOP) -> DataFrame:
    """Courses of the catalogue with the most enrolments; counted per id before the name is looked up."""
    per_course = transactions.filter(not_staff("email", staff_pattern)).groupBy("bundle_id").agg(F.count("*").alias("n"))
    named = per_course.join(catalogue.select("bundle_id", "course_name"), "bundle_id")
    return (named.groupBy(labels.or_not_set(F.col("course_name")).alias("label")).agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "label").limit(top))


def top_courses_by_name(transactions: DataFrame, staff_pattern: str = STAFF_PATTERN, top: int = TOP) -> DataFrame:
    return breakdown(transactions.filter(not_staff("email", staff_pattern)), F.col("course_name"), top)


def enrolment_sections(transactions: DataFrame, catalogue: DataFrame, staff_pattern: str = STAFF_PATTERN) -> DataFrame:
    """Sections 4, 8 and 10; the cube is written once, because two of their parts read it."""
    rolled = _roll_out(stored(_enrolment_cube(transactions, staff_pattern), "enrolment-cube"))
    n, revenue = F.col("n"), F.col("revenue")
    level = F.col("level")
    metrics = (
        _metric(level == "total", 4, "enrolments", n),
        _metric(level == "source", 4, "enrolments by source", n, labels.or_not_set(F.col("source"))),
        _metric(level == "total", 8, "revenue", revenue),
        _metric(level == "total", 8, "average paid price", mean(F.col("paid"), F.col("paid_n"))),
        _metric(level == "year", 8, "revenue by year", revenue, labels.or_not_set(F.col("year"))),
    )
    plain = _metrics(rolled, *metrics)
    named = (rolled.filter(level == "bundle_id").join(catalogue.select("bundle_id", F.col("course_name").alias("title")), "bundle_id")
             .groupBy(labels.or_not_set(F.col("title")).alias("label")).agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "label").limit(TOP))
    student = F.when(not_staff("email", staff_pattern), F.col("user_id"))
    people = transactions.agg(F.count("*").alias("n"), F.countDistinct(student).alias("students"))
    return union_all([
        plain,
        _metrics(people, _table_rows("transactions"), _metric(F.lit(True), 4, "unique students", F.col("students"))),
        _rows(named, 10, "top courses", n, F.col("label")),
    ])


def _metric(condition: Column, section: int, metric: str, value: Column, label: Column | None = None) -> Column:
    return F.when(condition, F.struct(
        F.lit(section).alias("section"), F.lit(metric).alias("metric"),
        (F.lit(None) if label is None else label).cast("string").alias("label"), value.cast(VALUE).alias("value")))


def full_report(tables: Mapping[str, DataFrame], as_of: date, staff_pattern: str = STAFF_PATTERN,
                events: DataFrame | None = None) -> DataFrame:
    """All sections over the silver tables (keys as in the warehouse: ``users``, ``transactions`` ...).

    A section that reads a table anyway also gives its row count.  Ordered by section and metric, larger values first,
    years in their order.
    """
    whole = union_all([
        *([data_health({}, events)] if events is not None else []),
        catalogue_section(tables["course_catalogue"]),
        batch_section(tables["course_batches"], as_of),
        enrolment_sections(tables["transactions"], tables["course_catalogue"], staff_pattern),
        student_section(tables["users"], staff_pattern),
        attendance_section(tables["class_attendance"]),
        assessment_section(tables["assessments"], tables["certificates"]),
        session_section(tables["sessions"]),
    ])
    by_label = F.when((F.col("section") == 1) | (F.col("metric") == "revenue by year"), F.col("label"))
    return whole.orderBy("section", "metric", by_label, F.desc("value"), "label")


def formatted(report: DataFrame) -> DataFrame:
    """Report with its values as display text."""
    metric = F.col("metric")
    text = (
        F.when(metric == "average attendance", labels.percent(F.col("value")))
        .when(metric.startswith("revenue") | (metric == "average paid price"), labels.two_decimals(F.col("value")))
        .otherwise(labels.thousands(F.col("value"))))
    return report.withColumn("text", text)
