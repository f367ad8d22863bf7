"""Files written from the given tables, then read by the sources."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from checks.common import query
from checks.entities import _ENROLMENTS_CTE, enrolments
from checks.fixtures import fixture, oracle, shares, table
from tutorlake import session
from tutorlake.functions.jsonfields import text_at, typed_at
from tutorlake.plans import attendance, courses
from tutorlake.sources import calendar, csvfiles, pages, sinks


def _in_order(df: DataFrame, key: str, files: int = 4) -> DataFrame:
    """Files whose names and rows both follow ``key``."""
    return df.repartitionByRange(files, key).sortWithinPartitions(key)


_STUDENT_HEADER = '#,Name,Email,Address,State,"Teaching Experience, if any",Age '


def _with_two_header_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": ["Student report, exported today", _STUDENT_HEADER]})
    yield from batches


@query("csv_students_scan", oracle("""
SELECT user_id AS source_row, CAST(user_id AS STRING) AS row_number, full_name AS name, email,
 'House "' || CAST(user_id AS STRING) || '",' || chr(10) || 'Street' AS address, state,
 CASE WHEN user_id % 3 = 0 THEN '5, or more' END AS teaching_experience, '44' AS age_v2, CAST(NULL AS STRING) AS website
FROM fx_users""", "users"))
def _(spark, sf_dir):
    users = fixture(spark, sf_dir, "users")
    line = F.concat_ws(
        ",", F.col("user_id").cast("string"), F.coalesce("full_name", F.lit("")), F.coalesce("email", F.lit("")),
        F.concat(F.lit('"House ""'), F.col("user_id").cast("string"), F.lit('"",\nStreet"')), F.col("state"),
        F.when(F.col("user_id") % 3 == 0, F.lit('"5, or more"')).otherwise(F.lit("")), F.lit("44"))
    path = session.scratch_path(spark, "students")
    lines = _in_order(users, "user_id", shares(spark, sf_dir, "customer")).select(line.alias("value"))
    lines.mapInPandas(_with_two_header_lines, "value string").write.text(path)
    read = csvfiles.read_students(spark, path)
    return read.select("source_row", "row_number", "name", "email", "address", "state", "teaching_experience", "age_v2", "website")


@query("csv_enrolments_scan", oracle("""
SELECT row_number() OVER (ORDER BY source_row) - 1 AS source_row, NULLIF(user_id, '') AS user_id, name, email, bundle_id, class_name,
 master_batch_id, NULLIF(institution_bundle_id, '') AS institution_bundle_id, classusers_end_date, CAST(NULL AS STRING) AS tutor_name
FROM enrolments""", "transactions", **_ENROLMENTS_CTE))
def _(spark, sf_dir):
    path = session.scratch_path(spark, "enrolments")
    # The blanks around cells are part of them.
    _in_order(enrolments(spark, sf_dir), "source_row", shares(spark, sf_dir, "lineitem", 4 << 20)).drop("source_row").write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return csvfiles.read_enrolments(spark, path).select(
        "source_row", "user_id", "name", "email", "bundle_id", "class_name", "master_batch_id", "institution_bundle_id",
        "classusers_end_date", "tutor_name")


def _catalogue_csv(spark, sf_dir) -> str:
    path = session.scratch_path(spark, "catalogue")
    parts = _in_order(table(spark, sf_dir, "part"), "p_partkey", shares(spark, sf_dir, "part"))
    parts.select(
        F.col("p_partkey").alias("#"), F.col("p_name").alias("Course Name"), F.col("p_type").alias("Course-Name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("Cost (INR) "), F.col("p_size").alias("Num. Students"),
    ).write.csv(path, header=True)
    return path


@query("csv_dynamic_header_scan", """
SELECT p_partkey AS source_row, CAST(p_partkey AS VARCHAR) AS key, p_name AS course_name, p_type AS course_name_1,
 CASE WHEN p_size % 2 = 0 THEN p_brand END AS cost_inr, CAST(p_size AS VARCHAR) AS num_students FROM part""")
def _(spark, sf_dir):
    read = csvfiles.read_csv_dynamic(spark, _catalogue_csv(spark, sf_dir))
    # A name without letters or digits leaves nothing; it gets one here.
    return read.toDF("source_row", "key", *read.columns[2:])


@query("csv_reload_idempotent", """
SELECT 'first load' AS load, COUNT(*) AS new_rows FROM part
UNION ALL SELECT 'second load', 0
UNION ALL SELECT 'after a broken load', COUNT(*) FROM part WHERE p_partkey >= 100""")
def _(spark, sf_dir):
    read = csvfiles.read_csv_dynamic(spark, _catalogue_csv(spark, sf_dir)).select("source_row", "course_name")
    empty = read.filter(F.lit(False))

    def count(label: str, target: DataFrame) -> DataFrame:
        return csvfiles.new_records(target, read).agg(F.count("*").alias("new_rows")).select(
            F.lit(label).alias("load"), "new_rows")

    return count("first load", empty).unionByName(count("second load", read)).unionByName(
        count("after a broken load", read.filter("source_row < 100")))


_ROW_ID = "CAST(k_order AS STRING) || ':' || CAST(k_line AS STRING) || ':' || CAST(k_part AS STRING)"


def _attendance_pages(spark, sf_dir) -> DataFrame:
    """One landed reply per order, its rows under varying keys and names."""
    row = F.when(F.col("k_line") % 2 == 0, F.to_json(F.struct(
        F.col("student_id").cast("string").alias("student_Id"), F.col("batch_id").alias("batch_Id"), F.col("class_id").alias("class_Id"),
        F.col("bundle_id").alias("bundle_Id"), F.col("student_email").alias("studentEmail"),
        F.col("attendance_status").alias("studentAttendanceStatus"), F.date_format("class_date_parsed", "dd MMM yyyy").alias("classDate"),
        F.expr(_ROW_ID).alias("studentComments"), F.lit("n/a").alias("studentRating"), F.lit(0).alias("teacher_Id"),
        F.col("teacher_id").alias("teacher_id")))).otherwise(F.to_json(F.struct(
            F.lit("").alias("student_Id"), F.col("student_id"), F.col("batch_id"), F.col("class_id"), F.col("bundle_id"),
            F.col("student_email"), F.col("attendance_status").alias("studentAttendanceStatus"),
            F.col("class_date_parsed").cast("string").alias("classDate"), F.expr(_ROW_ID).alias("studentComments"),
            F.col("student_rating").cast("string").alias("studentRating"))))
    # Line items are dealt by order while they are plain: their rows as text are many times larger.
    dealt = fixture(spark, sf_dir, "attendance", dealt=("lineitem", "l_orderkey"), share=1 << 20)
    rows = dealt.select("k_order", "pull_date", row.alias("row"))
    # An order has a handful of lines, so a page stays small.
    per_page = rows.groupBy("k_order", "pull_date").agg(F.concat_ws(",", F.collect_list("row")).alias("rows"))
    listed = F.concat(F.lit("["), F.col("rows"), F.lit("]"))
    key = F.col("k_order") % 3
    body = F.concat(
        F.lit('{"pull_date":"'), F.col("pull_date").cast("string"), F.lit('",'),
        F.when(key == 0, F.concat(F.lit('"data":'), listed)).when(key == 1, F.concat(F.lit('"data":null,"rows":'), listed))
        .otherwise(F.concat(F.lit('"report":'), listed)), F.lit("}"))
    path = session.scratch_path(spark, "attendance-pages")
    # Pages repeat their keys in every row; packed they take a quarter, for hardly any time.
    per_page.select(body.alias("value")).write.text(path, compression="snappy")
    read = pages.read_pages(spark, path, one_per_line=True)
    return read.withColumn("pull_date", text_at(F.col("doc"), "pull_date").cast("date"))


@query("json_rows_unwrap", oracle(f"""
SELECT pull_date, student_id, CASE WHEN k_line % 2 = 0 THEN NULLIF(batch_id, 0) ELSE batch_id END AS batch_id,
 CASE WHEN k_line % 2 = 0 THEN NULLIF(class_id, 0) ELSE class_id END AS class_id,
 CASE WHEN k_line % 2 = 0 THEN NULLIF(bundle_id, 0) ELSE bundle_id END AS bundle_id,
 student_email, attendance_status, class_date_parsed,
 CASE WHEN k_line % 2 = 1 THEN student_rating END AS student_rating, CASE WHEN k_line % 2 = 0 THEN teacher_id END AS teacher_id,
 {_ROW_ID} AS student_comments, COALESCE(lower(student_email) LIKE '%@staff%', FALSE) AS is_staff FROM fx_attendance""", "attendance"))
def _(spark, sf_dir):
    rows = pages.unwrap_rows(_attendance_pages(spark, sf_dir), "pull_date").withColumnRenamed("pos", "seq")
    return attendance.landed_rows(rows).select(
        "pull_date", "student_id", "batch_id", "class_id", "bundle_id", "student_email", "attendance_status", "class_date_parsed",
        "student_rating", "teacher_id", "student_comments", "is_staff")


@query("json_catalogue_unwrap", """
SELECT p_partkey AS source_row, CAST(p_partkey AS VARCHAR) AS bundle_id, p_name AS course_name,
 CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS subject, CAST(p_size AS VARCHAR) AS num_students, p_type AS type FROM part""")
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    titled = F.to_json(F.struct(
        F.col("p_partkey").alias("Bundle id"), F.lit("").alias("Course Name"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 3 == 0, F.lit("nan")).otherwise(F.col("p_brand")).alias("Subject"),
        F.lit(0).alias("Num Students"), F.col("p_size").alias("num_students"), F.col("p_type").alias("Type")))
    plain = F.to_json(F.struct(
        F.col("p_partkey").alias("bundle_id"), F.col("p_name").alias("course_name"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("subject"),
        F.col("p_size").alias("num_students"), F.col("p_type").alias("type")))
    item = F.when(F.col("p_partkey") % 2 == 0, titled).otherwise(plain)
    shape = F.col("p_partkey") % 4
    body = (F.when(shape == 0, F.concat(F.lit("["), item, F.lit("]")))
            .when(shape == 1, F.concat(F.lit('{"response":"ok","courses":['), item, F.lit("]}")))
            .when(shape == 2, F.concat(F.lit('{"data":{},"items":['), item, F.lit("]}")))
            .otherwise(F.concat(F.lit('{"c1":'), item, F.lit("}"))))
    path = session.scratch_path(spark, "catalogue-pages")
    parts.select(body.alias("value")).write.text(path)
    items = pages.unwrap_catalogue(pages.read_pages(spark, path, one_per_line=True)).withColumnRenamed("pos", "seq")
    return courses.upsert_catalogue_raw(courses.catalogue_rows(items)).select(
        "source_row", "bundle_id", "course_name", "subject", "num_students", "type")


@query("json_batches_flatten", oracle("""
SELECT (SELECT MAX(s_suppkey) + 1 FROM supplier) + row_number() OVER (ORDER BY bundle_id, batch_id) - 1 AS source_row,
 CAST(bundle_id AS STRING) AS bundle_id, bundle_name, CAST(batch_id AS STRING) AS batch_id, batch_name, batch_status,
 CASE WHEN batch_id % 2 = 0 OR admitted_students = 0 THEN '7' ELSE CAST(admitted_students AS STRING) END AS admitted_students, bundle_id % 2 = 0 AS has_more
FROM fx_batches""", "batches"))
def _(spark, sf_dir):
    batches = fixture(spark, sf_dir, "batches")
    even = F.col("batch_id") % 2 == 0
    batch = F.to_json(F.struct(
        F.col("batch_id").alias("class_id"), F.col("batch_name").alias("class_name"),
        F.when(F.col("batch_status") == "Archived", F.lit(1)).otherwise(F.lit(0)).alias("mb_archived"),
        F.when(even, F.lit(0)).otherwise(F.col("admitted_students")).alias("admitted_students"), F.lit(7).alias("registered_students")))
    # A course has at most three batches here; pages are numbered like their course.
    per_course = batches.groupBy("bundle_id", "bundle_name").agg(
        F.array_sort(F.collect_list(F.struct("batch_id", batch.alias("json")))).alias("entries"))
    listed = F.concat(F.lit("["), F.concat_ws(",", F.col("entries.json")), F.lit("]"))
    as_text = F.concat(F.lit('"'), F.replace(listed, F.lit('"'), F.lit('\\"')), F.lit('"'))
    even_course = F.col("bundle_id") % 2 == 0
    bundle = F.concat(
        F.lit('{"bundle_id":'), F.col("bundle_id").cast("string"), F.lit(',"bundle_name":"'), F.col("bundle_name"),
        F.lit('","batch":'), F.when(F.col("bundle_id") % 5 == 0, as_text).otherwise(listed), F.lit("}"))
    none = F.lit('{"bundle_id":-1,"bundle_name":"none"},{"bundle_id":-2,"batch":"[broken"},')
    body = F.when(even_course, F.concat(
        F.lit('{"page":'), F.col("bundle_id").cast("string"), F.lit(',"courses":['), none, bundle,
        F.lit('],"page_context":{"has_more_page":true}}'))).otherwise(F.concat(
            F.lit('{"page":'), F.col("bundle_id").cast("string"), F.lit(',"courses":['), bundle, F.lit("]}")))
    path = session.scratch_path(spark, "batch-pages")
    per_course.select(body.alias("value")).write.text(path)
    read = pages.has_more_page(pages.read_pages(spark, path, one_per_line=True))
    flat = pages.flatten_batches(read.withColumn("page_no", typed_at(F.col("doc"), "bigint", "page")), "page_no", "has_more")
    stored = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_row"))
    numbered = pages.number_rows(flat, "page_no", stored)
    rows = courses.upsert_batches_raw(courses.batch_rows(numbered)).join(numbered.select("source_row", "has_more"), "source_row")
    return rows.select("source_row", "bundle_id", "bundle_name", "batch_id", "batch_name", "batch_status", "admitted_students", "has_more")


@query("snapshot_roundtrip", """
SELECT 'json' AS kind, o_orderkey, o_custkey, o_orderpriority FROM orders
UNION ALL SELECT 'csv', o_orderkey, o_custkey, o_orderpriority FROM orders
UNION ALL SELECT 'table', o_orderkey, o_custkey, o_orderpriority FROM orders""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    root, taken = session.scratch_path(spark, "snapshots"), datetime(2024, 1, 2, 3, 4, 5)
    schema = rows.schema
    as_json = sinks.write_snapshot(rows, root, "orders", "orders_raw", "json", taken)
    as_csv = sinks.write_snapshot(rows, root, "orders", "orders_raw", "csv", taken)
    sinks.overwrite(rows, f"{root}/orders")
    sinks.overwrite(rows, f"{root}/orders")
    parts = {"json": spark.read.schema(schema).json(as_json), "csv": spark.read.schema(schema).csv(as_csv, header=True),
             "table": spark.read.parquet(f"{root}/orders")}
    tagged = [df.select(F.lit(kind).alias("kind"), "*") for kind, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("calendar_backfill", oracle("""
SELECT d.pull_date, date_diff('second', TIMESTAMP '1970-01-01', CAST(d.pull_date AS TIMESTAMP)) - 19800 AS start_epoch,
 date_diff('second', TIMESTAMP '1970-01-01', CAST(d.pull_date AS TIMESTAMP)) - 19800 + 86399 AS end_epoch, d.pull_date NOT IN
  (SELECT pull_date FROM fx_attendance) AS missing
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS pull_date
 FROM (SELECT MIN(pull_date) AS lo, MAX(pull_date) + 1 AS hi FROM fx_attendance) r) d""", "attendance"))
def _(spark, sf_dir):
    pulled = fixture(spark, sf_dir, "attendance").select("pull_date")
    first, last = pulled.agg(F.min("pull_date"), F.date_add(F.max("pull_date"), 1)).first()
    days = calendar.calendar(spark, *calendar.target_range(last, start=first, end=last))
    missing = calendar.missing_days(pulled, days).select("pull_date", F.lit(True).alias("missing"))
    return days.join(missing, "pull_date", "left").withColumn("missing", F.coalesce("missing", F.lit(False)))
