"""Course views, master tables, catalogue, lifecycle and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.common import fold_sql, query
from checks.fixtures import fixture, oracle, table
from tutorlake.operators.ranking import latest_row
from tutorlake.plans import courses, gold, metadata

_STAFF = "'%@staff%'"

#: Enrolments that count: one row per course and user.
_ENROLLED = f"""SELECT bundle_id, user_id, bool_or(source = 'webhook') AS live, bool_or(source = 'csv.import') AS imported,
 min(start_date) AS opened, max(start_date) AS newest
FROM fx_transactions WHERE user_id IS NOT NULL AND email IS NOT NULL AND NOT email LIKE {_STAFF} GROUP BY bundle_id, user_id"""

COURSE_VIEW = f"""
WITH enrolled AS ({_ENROLLED}),
heads AS (SELECT bundle_id, count(*) AS everyone, count(*) FILTER (WHERE coalesce(live, FALSE)) AS live,
 count(*) FILTER (WHERE coalesce(imported, FALSE)) AS imported FROM enrolled GROUP BY bundle_id),
stages AS (SELECT course_id AS bundle_id, type_of_launch, first_class_date, last_class_date,
 enrollments_on_fc AS enrollments_on_first_class, enrollments_on_lc AS enrollments_on_last_class,
 avg_attendance AS average_attendance, total_certified AS total_students_certified, overall_rating FROM fx_lifecycle),
described AS (SELECT DISTINCT bundle_id, course_name, course_type, status, subject, term_of_course, position_in_funnel,
 adhyayanam_category, sss_category, viniyoga, division, stages.* EXCLUDE (bundle_id)
 FROM fx_catalogue LEFT JOIN stages USING (bundle_id))
SELECT described.*, coalesce(everyone, 0) AS total_enrollments_count, coalesce(live, 0) AS live_enrollments_count,
 coalesce(imported, 0) AS historical_enrollments_count
FROM described LEFT JOIN heads USING (bundle_id)"""

LEARNER_VIEW = f"""
WITH enrolled AS ({_ENROLLED}),
debut AS (SELECT user_id, min(opened) AS day FROM enrolled GROUP BY user_id),
heads AS (SELECT bundle_id, count(*) AS everyone, count(*) FILTER (WHERE opened = day) AS fresh, count(*) FILTER (WHERE newest > day) AS back
 FROM enrolled JOIN debut USING (user_id) GROUP BY bundle_id)
SELECT heads.bundle_id, course_name, course_type, position_in_funnel, everyone AS total_learners_count,
 fresh AS new_learners_count, back AS returning_learners_count
FROM heads LEFT JOIN fx_catalogue ON fx_catalogue.bundle_id = heads.bundle_id"""

_COURSE_NEEDS = ("catalogue", "lifecycle", "transactions")


def course_view(spark, sf_dir) -> DataFrame:
    return gold.course(*[fixture(spark, sf_dir, n) for n in _COURSE_NEEDS])


def learner_view(spark, sf_dir) -> DataFrame:
    return gold.learner(fixture(spark, sf_dir, "transactions"), fixture(spark, sf_dir, "catalogue"))


@query("gold_course", oracle(COURSE_VIEW, *_COURSE_NEEDS))
def _(spark, sf_dir):
    return course_view(spark, sf_dir)


@query("gold_learner", oracle(LEARNER_VIEW, "transactions", "catalogue"))
def _(spark, sf_dir):
    return learner_view(spark, sf_dir)


_SUM_ENROLLED = "CAST(SUM(total_enrollments_count) AS BIGINT) AS total_enrollments_sum"
_SUM_STAGES = ("CAST(SUM(enrollments_on_first_class) AS BIGINT) AS total_enrollments_on_first_class, "
               "CAST(SUM(enrollments_on_last_class) AS BIGINT) AS total_enrollments_on_last_class")


def _over_course(select: str, sums: str, where: str = "", group: str = "ALL") -> str:
    return oracle(f"SELECT {select}, COUNT(DISTINCT bundle_id) AS total_courses_count, {sums} FROM course {where} GROUP BY {group}",
                  *_COURSE_NEEDS, course=COURSE_VIEW)


@query("gold_course_type", _over_course("course_type, status", f"{_SUM_ENROLLED}, {_SUM_STAGES}"))
def _(spark, sf_dir):
    return gold.course_type(course_view(spark, sf_dir))


@query("gold_launch_type", _over_course("type_of_launch", _SUM_ENROLLED, "WHERE type_of_launch IS NOT NULL"))
def _(spark, sf_dir):
    return gold.launch_type(course_view(spark, sf_dir))


@query("gold_subject", _over_course("subject, status", f"{_SUM_ENROLLED}, {_SUM_STAGES}", "WHERE subject IS NOT NULL"))
def _(spark, sf_dir):
    return gold.subject(course_view(spark, sf_dir))


@query("gold_learning_model", _over_course(
    "COALESCE(CASE WHEN viniyoga = 'True' THEN 'Viniyoga' END, adhyayanam_category) AS learning_model_name",
    _SUM_ENROLLED, group="1"))
def _(spark, sf_dir):
    return gold.learning_model(course_view(spark, sf_dir))


def _over_both(key: str, where: str = "") -> str:
    new, returning = (f"CAST(SUM({c}) AS BIGINT)" for c in ("l.new_learners_count", "l.returning_learners_count"))
    return oracle(f"""
SELECT c.{key}, COUNT(DISTINCT c.bundle_id) AS total_courses_count,
 CAST(SUM(c.total_enrollments_count) AS BIGINT) AS total_enrollments_sum, {new} AS total_new_learners,
 {returning} AS total_returning_learners, {new} + {returning} AS total_individual_learner_count
FROM course c LEFT JOIN learner l ON c.bundle_id = l.bundle_id {where} GROUP BY c.{key}""",
                  *_COURSE_NEEDS, course=COURSE_VIEW, learner=LEARNER_VIEW)


@query("gold_term", _over_both("term_of_course"))
def _(spark, sf_dir):
    return gold.term(course_view(spark, sf_dir), learner_view(spark, sf_dir))


@query("gold_funnel", _over_both("position_in_funnel"))
def _(spark, sf_dir):
    return gold.funnel(course_view(spark, sf_dir), learner_view(spark, sf_dir))


@query("gold_sss_domain", _over_both("sss_category", "WHERE c.sss_category IS NOT NULL"))
def _(spark, sf_dir):
    return gold.sss_domain(course_view(spark, sf_dir), learner_view(spark, sf_dir))


# --- master tables ---------------------------------------------------------

_TRAITS = ("course_division type subject level language sss_category adhyayanam_category personas position_in_funnel "
           "term_of_course texts certificate course_sponsor number_of_lectures duration").split()

MERGE = f"""
WITH usable AS (SELECT * FROM fx_batches WHERE strpos(batch_name, 'Test batch') = 0),
newest AS (SELECT bundle_id, arg_max(batch_id, (coalesce(start_date, DATE '0001-01-01'), batch_id)) AS batch_id
 FROM usable GROUP BY bundle_id),
lonely AS (SELECT bundle_id FROM fx_catalogue EXCEPT SELECT bundle_id FROM usable),
lines AS (
 SELECT bundle_id, bundle_name, batch_id, batch_name, batch_status, 1 AS has_batch, start_date, end_date, admitted_students,
  tutor_name, tutor_id, (bundle_id, batch_id) IN (SELECT (bundle_id, batch_id) FROM newest) AS top FROM usable
 UNION ALL BY NAME
 SELECT bundle_id, course_name AS bundle_name, 0 AS has_batch, 0 AS admitted_students
 FROM fx_catalogue WHERE bundle_id IN (FROM lonely))
SELECT l.bundle_id, l.bundle_name, l.batch_id, l.batch_name,
 if(coalesce(l.top, TRUE), c.status, 'Completed') AS final_status, c.status AS catalogue_status,
 CAST(coalesce(l.top, TRUE) AS INT) AS is_latest_batch,
 CAST(coalesce(l.top AND list_contains(['Completed', 'Ongoing', 'Upcoming'], c.status), FALSE) AS INT) AS include_in_course_count,
 '' AS status_adjustment_reason, c.status, l.batch_status, l.has_batch, l.start_date, l.end_date,
 l.admitted_students AS batch_enrollment_count, c.num_students AS bundle_enrollment_count, l.tutor_name, l.tutor_id,
 {', '.join('c.' + t for t in _TRAITS)}, '' AS computer_based_assessment, c.course_ids
FROM lines l LEFT JOIN fx_catalogue c ON c.bundle_id = l.bundle_id"""


@query("course_batch_merge", oracle(MERGE, "batches", "catalogue"))
def _(spark, sf_dir):
    return courses.batch_merge(fixture(spark, sf_dir, "batches"), fixture(spark, sf_dir, "catalogue"))


_MASTER_TRAITS = ("course_name subject course_type term_of_course position_in_funnel adhyayanam_category sss_category "
                  "viniyoga division").split()


@query("course_master", oracle(f"""
WITH newest AS (SELECT bundle_id, arg_max(batch_id, (coalesce(end_date, DATE '0001-01-01'), batch_id)) AS batch_id
 FROM fx_batches GROUP BY bundle_id),
lines AS (
 SELECT bundle_id, bundle_name, batch_id, batch_name, batch_status, start_date, end_date, tutor_name, admitted_students,
  (bundle_id, batch_id) IN (SELECT (bundle_id, batch_id) FROM newest) AS top, 1 AS has_batch FROM fx_batches
 UNION ALL BY NAME
 SELECT bundle_id, FALSE AS top, 0 AS has_batch FROM (SELECT bundle_id FROM fx_catalogue EXCEPT SELECT bundle_id FROM fx_batches) lonely)
SELECT l.* EXCLUDE (top, has_batch), {', '.join('c.' + t for t in _MASTER_TRAITS)}, c.status AS catalogue_status,
 c.status AS final_status, CAST(l.top AS INT) AS is_latest_batch,
 CAST(coalesce(l.has_batch = 1 AND c.course_division = 'Course'
  AND list_contains(['Completed', 'Ongoing', 'Upcoming'], c.status), FALSE) AS INT) AS include_in_course_count,
 '' AS status_adjustment_reason, l.has_batch
FROM lines l LEFT JOIN fx_catalogue c ON c.bundle_id = l.bundle_id""", "batches", "catalogue"))
def _(spark, sf_dir):
    return courses.master(fixture(spark, sf_dir, "batches"), fixture(spark, sf_dir, "catalogue"))


@query("courses_without_batches", oracle("""
SELECT bundle_id, course_name, status FROM fx_catalogue WHERE bundle_id NOT IN (SELECT bundle_id FROM fx_batches)""",
                                         "batches", "catalogue"))
def _(spark, sf_dir):
    return courses.without_batches(
        fixture(spark, sf_dir, "catalogue"), fixture(spark, sf_dir, "batches")).select("bundle_id", "course_name", "status")


@query("latest_batch_per_course", oracle("""
SELECT * FROM fx_batches QUALIFY row_number() OVER (
 PARTITION BY bundle_id ORDER BY start_date DESC NULLS LAST, batch_id DESC) = 1""", "batches"))
def _(spark, sf_dir):
    return latest_row(fixture(spark, sf_dir, "batches"), "bundle_id", ["start_date", "batch_id"])


@query("eligible_batches_case_insensitive", oracle("""
SELECT * FROM fx_batches WHERE batch_name IS NULL OR (batch_name NOT ILIKE '%test batch%' AND batch_name NOT ILIKE '%test%batch%')""",
                                                   "batches"))
def _(spark, sf_dir):
    return courses.eligible_batches(fixture(spark, sf_dir, "batches"))


# --- raw text into the catalogue, lifecycle and batch tables ----------------

#: Raw catalogue rows: ids in several spellings, two raw rows per course, messy text.
_RAW_CATALOGUE = """
SELECT p_partkey AS source_row,
 CASE WHEN p_partkey % 37 = 0 THEN 'n/a' WHEN p_partkey % 41 = 0 THEN '0'
      WHEN p_partkey % 3 = 0 THEN CAST(p_partkey - p_partkey % 2 AS STRING) || '.0'
      ELSE ' ' || CAST(p_partkey - p_partkey % 2 AS STRING) || ' ' END AS bundle_id,
 CASE WHEN p_partkey % 29 = 0 THEN 'nan' ELSE ' ' || p_name || ' ' END AS course_name,
 CASE WHEN p_partkey % 13 = 0 THEN 'None' ELSE p_brand END AS subject, p_type AS type,
 CASE WHEN p_size % 7 = 0 THEN 'Learning Path' WHEN p_size % 2 = 0 THEN ' COURSE ' ELSE 'Course' END AS course_division,
 CASE p_size % 4 WHEN 0 THEN 'Completed' WHEN 1 THEN 'Ongoing' WHEN 2 THEN 'Planned' END AS status,
 CASE WHEN p_size % 11 = 0 THEN 'many' ELSE '1,' || CAST(100 + p_size AS STRING) END AS num_students,
 CASE WHEN p_size % 6 = 0 THEN '#VALUE!' ELSE '2,' || CAST(100 + p_size AS STRING) || '.5' END AS cost
FROM {part}"""


def raw_catalogue(spark, sf_dir) -> DataFrame:
    return spark.sql(_RAW_CATALOGUE, part=table(spark, sf_dir, "part"))


_RAW_CTE = {"raw": _RAW_CATALOGUE.replace("{part}", "part")}
_CLEAN = "CASE WHEN trim({c}) NOT IN ('', 'nan', 'None', 'NaN') THEN trim({c}) END"
_KEY = "CASE WHEN regexp_matches(trim(bundle_id), '^[0-9.]+$') THEN CAST(trunc(CAST(trim(bundle_id) AS DOUBLE)) AS BIGINT) END"
_WHOLE_ID = "CASE WHEN regexp_matches(trim(bundle_id), '^[0-9]+$') THEN CAST(trim(bundle_id) AS BIGINT) END"
_STUDENTS = "CASE WHEN num_students <> 'many' THEN CAST(replace(num_students, ',', '') AS INT) END"
_JUDGED = f"""SELECT *, {_KEY} AS course_key, CASE WHEN {_KEY} IS NULL OR {_KEY} = 0 THEN 'invalid_id'
 WHEN lower(trim(course_division)) <> 'course' THEN 'not_a_course' ELSE 'ok' END AS verdict FROM raw"""


@query("catalogue_upsert_api", oracle(f"""
SELECT course_key AS bundle_id, {_CLEAN.format(c='course_name')} AS course_name, {_CLEAN.format(c='subject')} AS subject,
 type, type AS course_type, trim(course_division) AS course_division,
 CASE WHEN status IN ('Completed', 'Ongoing', 'Upcoming') THEN status END AS status, {_STUDENTS} AS num_students
FROM judged WHERE verdict = 'ok' QUALIFY row_number() OVER (PARTITION BY course_key ORDER BY source_row) = 1""",
                                      **_RAW_CTE, judged=_JUDGED))
def _(spark, sf_dir):
    return courses.catalogue_from_raw(raw_catalogue(spark, sf_dir)).select(
        "bundle_id", "course_name", "subject", "type", "course_type", "course_division", "status", "num_students")


@query("catalogue_rejects", oracle(
    "SELECT source_row, bundle_id, verdict FROM judged WHERE verdict <> 'ok'", **_RAW_CTE, judged=_JUDGED))
def _(spark, sf_dir):
    judged = courses.judge_catalogue(raw_catalogue(spark, sf_dir))
    return judged.filter(F.col("verdict") != "ok").select("source_row", "bundle_id", "verdict")


@query("catalogue_upsert_csv", oracle(
    fold_sql("typed", ["bundle_id"], ["source_row"], first=["subject"], last=["course_name", "status", "num_students"]),
    **_RAW_CTE, typed=f"""
SELECT source_row, {_WHOLE_ID} AS bundle_id, {_CLEAN.format(c='course_name')} AS course_name,
 {_CLEAN.format(c='subject')} AS subject, status, {_STUDENTS} AS num_students FROM raw WHERE {_WHOLE_ID} IS NOT NULL"""))
def _(spark, sf_dir):
    return courses.catalogue_from_csv(raw_catalogue(spark, sf_dir))


@query("catalogue_insert_only", oracle(
    fold_sql("typed", ["bundle_id"], ["source_row"], first=["course_name", "cost"]),
    **_RAW_CTE, typed=f"""
SELECT source_row, {_WHOLE_ID} AS bundle_id, {_CLEAN.format(c='course_name')} AS course_name,
 CASE WHEN cost <> '#VALUE!' THEN CAST(replace(cost, ',', '') AS DOUBLE) END AS cost FROM raw WHERE {_WHOLE_ID} IS NOT NULL"""))
def _(spark, sf_dir):
    return courses.catalogue_insert_only(raw_catalogue(spark, sf_dir))


#: Raw tracker rows: thousands separators, spreadsheet errors, month-first dates, repeated (course, batch) pairs.
_RAW_TRACKER = """
SELECT l_orderkey * 10 + l_linenumber AS source_row, CAST(l_partkey AS STRING) AS course_id,
 CASE WHEN l_linenumber = 7 THEN 'None' ELSE ' Supplier#' || CAST(l_suppkey AS STRING) END AS batch_name,
 'Course ' || CAST(l_partkey AS STRING) AS course_name, l_linestatus AS status, l_returnflag AS type_of_launch,
 CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING)
  AS first_class_date,
 CASE WHEN l_linenumber = 2 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS last_class_and_valedictory_date,
 '1,' || CAST(100 + CAST(l_quantity AS INT) AS STRING) AS enrolments_on_the_day_of_first_class,
 CASE WHEN l_linenumber = 3 THEN '#VALUE!' ELSE CAST(CAST(l_quantity AS INT) * 20 AS STRING) END AS enrolments_on_last_day,
 CAST(CAST(l_quantity AS INT) AS STRING) || '.5' AS average_attendance_of_all_classes,
 CAST(CAST(l_quantity AS INT) * 2 AS STRING) AS total_students_certified,
 CAST(CAST(l_quantity AS INT) * 3 AS STRING) AS first_class_attendance,
 CASE WHEN l_linenumber = 4 THEN '0' ELSE CAST(CAST(l_quantity AS INT) * 2 + 3 AS STRING) END AS last_class_attendance,
 CAST(l_linenumber % 5 AS STRING) || '.25' AS overall_course_rating, l_extendedprice AS k_price, l_shipdate AS k_ship
FROM {lineitem}"""


def raw_tracker(spark, sf_dir) -> DataFrame:
    rows = spark.sql(_RAW_TRACKER, lineitem=table(spark, sf_dir, "lineitem"))
    # Record numbers repeat in the given rows; price and date make their order unique.
    return rows.withColumn("source_row", F.struct("source_row", "k_price", "k_ship"))


_TRACKER_CTE = {"tracker": _RAW_TRACKER.replace("{lineitem}", "lineitem"), "typed": """
SELECT source_row, k_price, k_ship, CAST(course_id AS BIGINT) AS course_id, trim(batch_name) AS batch_name, course_name,
 status, type_of_launch,
 CAST(strptime(first_class_date, '%m/%d/%Y') AS DATE) AS first_class_date,
 TRY_CAST(last_class_and_valedictory_date AS DATE) AS last_class_date,
 CAST(replace(enrolments_on_the_day_of_first_class, ',', '') AS INT) AS enrollments_on_fc,
 TRY_CAST(enrolments_on_last_day AS INT) AS enrollments_on_lc,
 CAST(average_attendance_of_all_classes AS DECIMAL(8,2)) AS avg_attendance,
 CAST(total_students_certified AS INT) AS total_certified, CAST(overall_course_rating AS DECIMAL(3,2)) AS overall_rating,
 CAST(first_class_attendance AS INT) AS first_present, CAST(last_class_attendance AS INT) AS last_present
FROM tracker WHERE batch_name <> 'None'"""}
_LIFECYCLE_FIRST = ("course_name type_of_launch first_class_date last_class_date enrollments_on_fc enrollments_on_lc "
                    "avg_attendance total_certified overall_rating").split()


@query("lifecycle_upsert", oracle(
    fold_sql("typed", ["course_id", "batch_name"], ["source_row", "k_price", "k_ship"], first=_LIFECYCLE_FIRST, last=["status"]),
    **_TRACKER_CTE))
def _(spark, sf_dir):
    return courses.upsert_lifecycle(raw_tracker(spark, sf_dir)).select("course_id", "batch_name", *_LIFECYCLE_FIRST, "status")


#: Raw batch rows: one per order, ids and dates in several spellings.
_RAW_BATCHES = """
SELECT o_orderkey AS source_row, CAST(o_custkey % 7 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '.0' END AS bundle_id,
 'Bundle ' || CAST(o_custkey % 7 AS STRING) AS bundle_name,
 CASE WHEN o_orderkey % 53 = 0 THEN 'nan' ELSE CAST(o_custkey AS STRING) END AS batch_id,
 CASE WHEN o_orderkey % 19 = 0 THEN 'TEST my batch' WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS batch_name,
 CASE WHEN o_orderstatus = 'F' THEN 'Archived' ELSE 'Active' END AS batch_status,
 CAST(EPOCH(o_orderdate) AS STRING) AS start_date,
 CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE REPLACE(CAST(date_trunc('second', o_orderdate) AS STRING), ' ', 'T') || '+05:30' END AS end_date,
 CAST(o_custkey AS STRING) AS tutor_id, ' Tutor ' AS tutor_name, '1,' || CAST(100 + o_orderkey % 900 AS STRING) AS admitted_students
FROM {orders}"""


@query("batches_upsert", oracle(
    fold_sql("typed", ["bundle_id", "batch_id"], ["source_row"],
             last=["bundle_name", "batch_name", "batch_status", "start_epoch", "end_epoch", "tutor_id", "tutor_name", "admitted_students"]),
    raw=_RAW_BATCHES.replace("{orders}", "orders").replace("EPOCH(o_orderdate)", "date_diff('second', TIMESTAMP '1970-01-01', o_orderdate)"),
    typed="""
SELECT source_row, CAST(CAST(bundle_id AS DOUBLE) AS BIGINT) AS bundle_id, CAST(batch_id AS BIGINT) AS batch_id, bundle_name,
 batch_name, batch_status, CAST(start_date AS BIGINT) AS start_epoch,
 date_diff('second', TIMESTAMP '1970-01-01', CAST(NULLIF(left(end_date, 19), '') AS TIMESTAMP)) AS end_epoch,
 CAST(tutor_id AS BIGINT) AS tutor_id, trim(tutor_name) AS tutor_name, CAST(replace(admitted_students, ',', '') AS INT) AS admitted_students
FROM raw WHERE batch_id <> 'nan' AND (batch_name IS NULL OR batch_name NOT ILIKE '%test%batch%')"""))
def _(spark, sf_dir):
    text = _RAW_BATCHES.replace(
        "EPOCH(o_orderdate)", "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate)")
    typed = courses.upsert_batches(spark.sql(text, orders=table(spark, sf_dir, "orders")))
    return typed.select(
        "bundle_id", "batch_id", "bundle_name", "batch_name", "batch_status",
        F.unix_seconds("start_date").alias("start_epoch"), F.unix_seconds("end_date").alias("end_epoch"),
        "tutor_id", "tutor_name", "admitted_students")


# --- course metadata -------------------------------------------------------

def _ratio_sql(part: str, whole: str) -> str:
    p, w = f"CAST({part} * 100 AS BIGINT)", f"CAST({whole} * 100 AS BIGINT)"
    return f"CAST(CAST(({p} * 20000 + {w}) // NULLIF(2 * {w}, 0) AS DOUBLE) / 100 AS DECIMAL(18,2))"


@query("course_metadata", oracle(f"""
SELECT m.bundle_id, COALESCE(t.course_name, m.bundle_name) AS course_name, m.batch_id, m.batch_name, m.is_latest_batch,
 m.include_in_course_count, m.has_batch, m.batch_enrollment_count AS admitted_students,
 m.bundle_enrollment_count AS num_students, t.first_class_date, t.last_class_date,
 t.enrollments_on_fc AS enrollments_on_first_class, t.enrollments_on_lc AS enrollments_on_last_day,
 t.first_present AS first_class_attendance, t.last_present AS last_class_attendance, t.total_certified, t.avg_attendance,
 {_ratio_sql('t.total_certified', 't.enrollments_on_fc')} AS cert_vs_initial_enroll,
 {_ratio_sql('t.total_certified', 't.enrollments_on_lc')} AS cert_vs_end_enroll,
 {_ratio_sql('t.total_certified', 't.first_present')} AS cert_vs_first_class_attend,
 {_ratio_sql('t.total_certified', 't.avg_attendance')} AS cert_vs_avg_attend,
 {_ratio_sql('t.first_present', 't.enrollments_on_fc')} AS first_class_attend_vs_initial,
 {_ratio_sql('t.first_present', 't.last_present')} AS first_class_attend_vs_last,
 {_ratio_sql('t.enrollments_on_lc', 't.total_certified')} AS pass_pct_students_vs_cert
FROM (SELECT * REPLACE ('Supplier#' || CAST(batch_id AS STRING) AS batch_name) FROM merged) m
LEFT JOIN (SELECT * FROM typed QUALIFY row_number() OVER (
 PARTITION BY course_id, batch_name ORDER BY source_row, k_price, k_ship) = 1) t
 ON m.bundle_id = t.course_id AND m.batch_name = t.batch_name""", "batches", "catalogue", merged=MERGE, **_TRACKER_CTE))
def _(spark, sf_dir):
    merged = courses.batch_merge(fixture(spark, sf_dir, "batches"), fixture(spark, sf_dir, "catalogue"))
    merged = merged.withColumn("batch_name", F.concat(F.lit("Supplier#"), F.col("batch_id").cast("string")))
    wide = metadata.course_metadata(merged, raw_tracker(spark, sf_dir))
    return wide.select(
        "bundle_id", "course_name", "batch_id", "batch_name", "is_latest_batch", "include_in_course_count", "has_batch",
        "admitted_students", "num_students", "first_class_date", "last_class_date", "enrollments_on_first_class",
        "enrollments_on_last_day", "first_class_attendance", "last_class_attendance", "total_certified", "avg_attendance",
        "cert_vs_initial_enroll", "cert_vs_end_enroll", "cert_vs_first_class_attend", "cert_vs_avg_attend",
        "first_class_attend_vs_initial", "first_class_attend_vs_last", "pass_pct_students_vs_cert")
