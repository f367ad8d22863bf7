"""Report sections and data-quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from checks.attendance import CLASSES_CTES, classes, raw
from checks.common import mean6_sql, query
from checks.courses import _STAFF
from checks.entities import events
from checks.fixtures import fixture, oracle
from checks.messages import messages
from tutorlake import session
from tutorlake.functions import labels
from tutorlake.operators import dedup, envelope, predicates
from tutorlake.plans import quality, reports, routing

AS_OF = date(2001, 9, 1)


def tx(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "transactions")


_STUDENT_TX = f"(SELECT * FROM fx_transactions WHERE email NOT LIKE {_STAFF}) t"


@query("report_row_counts", oracle("""
SELECT 'silver.course_batches' AS table_name, COUNT(*) AS row_count FROM fx_batches
UNION ALL SELECT 'silver.course_catalogue', COUNT(*) FROM fx_catalogue
UNION ALL SELECT 'silver.transactions', COUNT(*) FROM fx_transactions
UNION ALL SELECT 'silver.users', COUNT(*) FROM fx_users ORDER BY table_name""", "batches", "catalogue", "transactions", "users"))
def _(spark, sf_dir):
    names = {"course_batches": "batches", "course_catalogue": "catalogue", "transactions": "transactions", "users": "users"}
    return reports.row_counts({f"silver.{name}": fixture(spark, sf_dir, fx) for name, fx in names.items()})


@query("report_breakdowns", oracle("""
SELECT 'subject' AS kind, COALESCE(subject, '(not set)') AS label, COUNT(*) AS n FROM fx_catalogue GROUP BY ALL
UNION ALL SELECT 'batch_status', COALESCE(batch_status, '(not set)'), COUNT(*) FROM fx_batches GROUP BY ALL""", "catalogue", "batches"))
def _(spark, sf_dir):
    by_subject = reports.breakdown(fixture(spark, sf_dir, "catalogue"), F.col("subject"))
    by_status = reports.breakdown(fixture(spark, sf_dir, "batches"), F.col("batch_status"))
    return by_subject.select(F.lit("subject").alias("kind"), "label", "n").unionByName(
        by_status.select(F.lit("batch_status").alias("kind"), "label", "n"))


@query("report_top_states", oracle(f"""
SELECT COALESCE(state, '(not set)') AS label, COUNT(*) AS n FROM fx_users WHERE email NOT LIKE {_STAFF}
GROUP BY 1 ORDER BY n DESC, label LIMIT 5""", "users"))
def _(spark, sf_dir):
    students = fixture(spark, sf_dir, "users").filter(predicates.not_staff())
    return reports.breakdown(students, F.col("state"), reports.TOP)


@query("report_top_courses", oracle(f"""
SELECT c.course_name AS label, COUNT(*) AS n FROM {_STUDENT_TX} JOIN fx_catalogue c ON t.bundle_id = c.bundle_id
GROUP BY 1 ORDER BY n DESC, label LIMIT 5""", "transactions", "catalogue"))
def _(spark, sf_dir):
    return reports.top_courses(tx(spark, sf_dir), fixture(spark, sf_dir, "catalogue"))


@query("report_top_courses_by_name", oracle(f"""
SELECT course_name AS label, COUNT(*) AS n FROM {_STUDENT_TX} GROUP BY 1 ORDER BY n DESC, label LIMIT 5""", "transactions"))
def _(spark, sf_dir):
    return reports.top_courses_by_name(tx(spark, sf_dir))


@query("report_revenue_by_year", oracle(f"""
SELECT CAST(year(created_at) AS INT) AS year, CAST(SUM(final_price) AS DECIMAL(22,2)) AS revenue FROM {_STUDENT_TX}
GROUP BY 1 ORDER BY 1""", "transactions"))
def _(spark, sf_dir):
    return reports.revenue_by_year(tx(spark, sf_dir))


@query("report_average_paid", oracle(f"""
SELECT {mean6_sql('final_price')} AS average_paid, COUNT(*) AS n FROM {_STUDENT_TX} WHERE final_price > 0""", "transactions"))
def _(spark, sf_dir):
    return reports.average_paid(tx(spark, sf_dir))


@query("report_active_batches", oracle(f"""
SELECT batch_id, end_date FROM fx_batches WHERE end_date >= DATE '{AS_OF}'""", "batches"))
def _(spark, sf_dir):
    return reports.active_batches(fixture(spark, sf_dir, "batches"), AS_OF).select("batch_id", "end_date")


@query("report_enrolments_by_source", oracle(f"""
SELECT COALESCE(source, '(not set)') AS label, COUNT(*) AS n FROM {_STUDENT_TX} GROUP BY 1""", "transactions"))
def _(spark, sf_dir):
    return reports.enrolments_by_source(tx(spark, sf_dir))


@query("report_freshness", oracle("""
SELECT MAX(received_epoch) AS latest, CAST((MAX(received_epoch) + 200000 - MAX(received_epoch)) // 86400 AS STRING) || ' days ago'
 AS age FROM logged""", "logged"))
def _(spark, sf_dir):
    latest = events(spark, sf_dir).agg(F.max("received_epoch").alias("latest"))
    return latest.select("latest", labels.days_ago(F.col("latest"), F.col("latest") + 200000).alias("age"))


_FOLDED = ("assessments", "certificates", "sessions")


def report_events(spark, sf_dir) -> DataFrame:
    """First copies of the events behind the report's entity tables, their data as text, with no more columns than these tables read."""
    accepted = envelope.accepted(envelope.parse(messages(spark, sf_dir, dealt=True)))
    texts = accepted.select("seq", "received_at", "event_id", "event_type", "event_epoch", F.to_json("data").alias("data"))
    # Copies are told apart among all events; an event that another table takes may be the first of its id.
    return dedup.first_seen(texts, ["event_id"], ["seq"]).filter(envelope.route(F.col("event_type")).isin(*_FOLDED))


def report_tables(spark, sf_dir) -> dict[str, DataFrame]:
    heard = session.stored(report_events(spark, sf_dir), "events").withColumn("data", F.parse_json("data"))
    sessions = routing.fold_table(heard, "sessions").withColumn(
        "cancellation_reason", F.when(F.col("status").isNull(), F.lit("cancelled")))
    return {
        "course_catalogue": fixture(spark, sf_dir, "catalogue"), "course_batches": fixture(spark, sf_dir, "batches"),
        "transactions": tx(spark, sf_dir), "users": fixture(spark, sf_dir, "users"), "class_attendance": classes(spark, sf_dir),
        "assessments": routing.fold_table(heard, "assessments"), "certificates": routing.fold_table(heard, "certificates"),
        "sessions": sessions,
    }


_V = "CAST({} AS DECIMAL(24,6))"
_N = _V.format("COUNT(*)")
_REPORT_CTES = {
    **CLASSES_CTES,
    "student_tx": f"SELECT * FROM fx_transactions WHERE email NOT LIKE {_STAFF}",
    "assessments": "SELECT eid FROM logged WHERE etype LIKE 'assessments.%' AND NOT bad_mark",
    "certificates": "SELECT eid FROM logged WHERE etype LIKE 'certificate.%'",
    "sessions": """SELECT u, list(CASE WHEN etype NOT LIKE '%cancel' THEN st END ORDER BY seq DESC)[1] AS status
 FROM logged WHERE etype LIKE 'session.%' AND NOT no_user GROUP BY u""",
}
_COUNTED = {"course_catalogue": "fx_catalogue", "course_batches": "fx_batches", "transactions": "fx_transactions",
            "users": "fx_users", "class_attendance": "classes", "assessments": "assessments", "certificates": "certificates",
            "sessions": "sessions"}
_PARTS = [f"SELECT 1 AS section, 'rows' AS metric, '{name}' AS label, {_N} AS value FROM {cte}" for name, cte in _COUNTED.items()]
_PARTS += [
    f"SELECT 2, 'courses', NULL, {_N} FROM fx_catalogue",
    f"SELECT 2, 'courses by subject', COALESCE(subject, '(not set)'), {_N} FROM fx_catalogue GROUP BY subject",
    f"SELECT 3, 'batches', NULL, {_N} FROM fx_batches",
    f"SELECT 3, 'batches by status', batch_status, {_N} FROM fx_batches GROUP BY batch_status",
    f"SELECT 3, 'ongoing or future batches', NULL, {_N} FROM fx_batches WHERE end_date >= DATE '{AS_OF}'",
    f"SELECT 4, 'enrolments', NULL, {_N} FROM student_tx",
    f"SELECT 4, 'enrolments by source', source, {_N} FROM student_tx GROUP BY source",
    f"SELECT 4, 'unique students', NULL, {_V.format('COUNT(DISTINCT user_id)')} FROM student_tx",
    f"SELECT 5, 'registered users', NULL, {_N} FROM fx_users",
    f"SELECT 5, 'students', NULL, {_N} FROM fx_users WHERE email NOT LIKE {_STAFF}",
    f"SELECT * FROM (SELECT 5, 'top states', state, {_N} FROM fx_users WHERE email NOT LIKE {_STAFF} GROUP BY state "
    "ORDER BY COUNT(*) DESC, state LIMIT 5)",
    f"SELECT 6, 'class records', NULL, {_N} FROM classes",
    f"SELECT 6, 'average attendance', NULL, {mean6_sql('attendance_pct')} FROM classes",
    f"SELECT 7, 'assessment events', NULL, {_N} FROM assessments",
    f"SELECT 7, 'certificates issued', NULL, {_N} FROM certificates",
    f"SELECT 8, 'revenue', NULL, {_V.format('SUM(final_price)')} FROM student_tx",
    f"SELECT 8, 'average paid price', NULL, {mean6_sql('final_price')} FROM student_tx WHERE final_price > 0",
    f"SELECT 8, 'revenue by year', COALESCE(CAST(year(created_at) AS STRING), '(not set)'), {_V.format('SUM(final_price)')} "
    "FROM student_tx GROUP BY year(created_at)",
    f"SELECT 9, 'sessions', NULL, {_N} FROM sessions",
    f"SELECT 9, 'cancelled sessions', NULL, {_V.format('COUNT(*) FILTER (WHERE status IS NULL)')} FROM sessions",
    f"SELECT * FROM (SELECT 10, 'top courses', c.course_name, {_N} FROM student_tx t JOIN fx_catalogue c ON t.bundle_id = c.bundle_id "
    "GROUP BY c.course_name ORDER BY COUNT(*) DESC, c.course_name LIMIT 5)",
]


@query("report_all", oracle("\nUNION ALL ".join(_PARTS), "catalogue", "batches", "transactions", "users", "attendance", "logged",
                            **_REPORT_CTES))
def _(spark, sf_dir):
    return reports.full_report(report_tables(spark, sf_dir), AS_OF)


@query("report_enrolment_breakdowns", oracle("""
SELECT * REPLACE (CAST(revenue AS DECIMAL(32,2)) AS revenue) FROM (
SELECT 'total' AS level, NULL AS label, COUNT(*) AS n, SUM(final_price) AS revenue FROM student_tx
UNION ALL SELECT 'source', source, COUNT(*), SUM(final_price) FROM student_tx GROUP BY source
UNION ALL SELECT 'year', CAST(year(created_at) AS STRING), COUNT(*), SUM(final_price) FROM student_tx GROUP BY year(created_at)
UNION ALL SELECT 'bundle_id', CAST(bundle_id AS STRING), COUNT(*), SUM(final_price) FROM student_tx GROUP BY bundle_id
UNION ALL SELECT 'course_name', course_name, COUNT(*), SUM(final_price) FROM student_tx GROUP BY course_name) rolled""",
                                             "transactions", student_tx=_REPORT_CTES["student_tx"]))
def _(spark, sf_dir):
    rolled = reports.enrolment_breakdowns(tx(spark, sf_dir))
    label = F.coalesce(*[F.col(c).cast("string") for c in ("source", "year", "bundle_id", "course_name")])
    return rolled.select("level", label.alias("label"), "n", F.col("revenue").cast("decimal(32,2)").alias("revenue"))


# --- data quality ----------------------------------------------------------

@query("quality_row_counts", oracle("""
SELECT 'bronze.attendance_raw' AS table_name, COUNT(*) AS row_count FROM fx_attendance
UNION ALL SELECT 'silver.class_attendance', COUNT(*) FROM classes
UNION ALL SELECT 'silver.users', COUNT(*) FROM fx_users ORDER BY 1""", "attendance", "users", **CLASSES_CTES))
def _(spark, sf_dir):
    return quality.row_counts({
        "bronze.attendance_raw": raw(spark, sf_dir), "silver.class_attendance": classes(spark, sf_dir),
        "silver.users": fixture(spark, sf_dir, "users")})


_PROFILED = {
    "silver.course_lifecycle": ("fx_lifecycle", {
        "course_id": "bigint", "batch_name": "string", "type_of_launch": "string", "first_class_date": "date",
        "last_class_date": "date", "enrollments_on_fc": "int", "enrollments_on_lc": "int", "avg_attendance": "decimal(8,2)",
        "total_certified": "int", "overall_rating": "decimal(3,2)"}),
    "silver.users": ("fx_users", {
        "user_id": "bigint", "email": "string", "full_name": "string", "state": "string", "segment": "string"}),
}


@query("quality_columns", oracle("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, COUNT(*) AS row_count, "
    f"COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {c}) AS distinct_count FROM {cte}"
    for name, (cte, columns) in _PROFILED.items() for c, kind in columns.items()), "lifecycle", "users"))
def _(spark, sf_dir):
    return quality.columns({
        "silver.course_lifecycle": fixture(spark, sf_dir, "lifecycle"), "silver.users": fixture(spark, sf_dir, "users")})


@query("quality_samples", oracle("""
SELECT * FROM (SELECT 'batches' AS kind, batch_id AS id, start_date AS day FROM fx_batches ORDER BY batch_id LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'latest classes', class_id, class_date FROM classes ORDER BY class_date DESC, class_id LIMIT 10)""",
                                 "batches", "attendance", **CLASSES_CTES))
def _(spark, sf_dir):
    first = quality.sample(fixture(spark, sf_dir, "batches"), ["batch_id"])
    newest = quality.latest(classes(spark, sf_dir), "class_date", ["class_id"])
    return first.select(F.lit("batches").alias("kind"), F.col("batch_id").alias("id"), F.col("start_date").alias("day")).unionByName(
        newest.select(F.lit("latest classes").alias("kind"), F.col("class_id").alias("id"), F.col("class_date").alias("day")))


@query("quality_layer_gap", oracle("""
SELECT 'attendance' AS entity, (SELECT COUNT(*) FROM fx_attendance) AS bronze_rows, COUNT(*) AS silver_rows, FALSE AS gap,
 CAST(0 AS BIGINT) AS unexpected_nulls FROM classes
UNION ALL SELECT 'unrouted', COUNT(*), 0, COUNT(*) > 0, 0 FROM fx_transactions
UNION ALL SELECT 'users', (SELECT COUNT(*) FROM customer), COUNT(*), FALSE, COUNT(*) - COUNT(email) FROM fx_users""",
                                   "attendance", "transactions", "users", **CLASSES_CTES))
def _(spark, sf_dir):
    users, enrolled = fixture(spark, sf_dir, "users"), tx(spark, sf_dir)
    return quality.layer_gap({
        "attendance": (raw(spark, sf_dir), classes(spark, sf_dir)),
        "unrouted": (enrolled, enrolled.filter("source = 'nowhere'")),
        "users": (users, users),
    }, {"users": ["user_id", "email"], "attendance": ["batch_id", "class_date"]})


@query("quality_populated", oracle("""
SELECT 'check_batches' AS table_name, COUNT(*) AS row_count, 'OK' AS status FROM fx_batches
UNION ALL SELECT 'check_empty', 0, 'EMPTY' UNION ALL SELECT 'check_missing', NULL, 'ERROR'""", "batches"))
def _(spark, sf_dir):
    batches = fixture(spark, sf_dir, "batches")
    batches.createOrReplaceTempView("check_batches")
    batches.filter("batch_status = 'Unknown'").createOrReplaceTempView("check_empty")
    return quality.populated(spark, ["check_batches", "check_empty", "check_missing"])


_TEST_EMAIL = "CASE WHEN k_line = 1 THEN 'test.' || email WHEN k_line = 2 THEN 'upload.' || email ELSE email END"
_TEST_USER = "user_id + CASE WHEN k_line = 3 THEN 99990000 ELSE 0 END"
_TEST_EVENT = "CASE WHEN k_line = 1 THEN 'e2e-' WHEN k_line = 2 THEN 'reload-' ELSE '' END || event_id"


@query("cleanup_test_rows", oracle("""
SELECT 'bronze.webhook_events' AS table_name, COUNT(*) FILTER (WHERE k_line = 1) AS found,
 COUNT(*) FILTER (WHERE k_line <> 1) AS kept, COUNT(*) FILTER (WHERE k_line <> 1) AS rows_after FROM fx_transactions
UNION ALL
SELECT 'silver.transactions', COUNT(*) FILTER (WHERE hit), COUNT(*) FILTER (WHERE NOT hit), COUNT(*) FILTER (WHERE NOT hit)
FROM (SELECT (k_line IN (1, 2) AND email IS NOT NULL) OR k_line = 3 AS hit FROM fx_transactions) t""", "transactions"))
def _(spark, sf_dir):
    rows = tx(spark, sf_dir).select(
        F.expr(_TEST_EMAIL).alias("email"), F.expr(_TEST_USER).alias("user_id"), F.expr(_TEST_EVENT).alias("event_id"))
    tables = {
        "silver.transactions": (rows, predicates.test_user(F.col("email"), F.col("user_id"))),
        "bronze.webhook_events": (rows, predicates.test_event(F.col("event_id"))),
    }
    kept = {name: quality.split_test_rows(df, predicate)[1] for name, (df, predicate) in tables.items()}
    after = reports.row_counts(kept).withColumnRenamed("row_count", "rows_after")
    return quality.test_row_counts(tables).join(after, "table_name")
