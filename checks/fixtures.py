"""The given tables shaped into the warehouse's schemas.

Each fixture is one SQL text that both engines run: Spark on DataFrames, the
oracle as a common table expression.  Fixtures only shape input; the operators
under test never appear in them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tutorlake.streaming.tables import bytes_below

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def bundle_of(key: str) -> str:
    """Three batches share a course; some batches name a course that is not listed."""
    return f"(CASE WHEN {key} % 29 = 28 THEN 900000000 + {key} ELSE {key} - {key} % 3 END)"


def email_of(key: str, segment: str) -> str:
    return (f"CASE WHEN {key} % 13 = 0 THEN NULL WHEN {segment} = 'MACHINERY' "
            f"THEN 'u' || CAST({key} AS STRING) || '@staff.example' "
            f"ELSE 'u' || CAST({key} AS STRING) || '@mail.example' END")


#: Arrival order of line items: unique as a whole.
SEQ = ["k_order", "k_line", "k_part", "k_supp", "k_ship", "k_price"]
SEQ_SQL = ", ".join(SEQ)
_SEQ_COLUMNS = ("l_orderkey AS k_order, l_linenumber AS k_line, l_partkey AS k_part, l_suppkey AS k_supp, "
                "l_shipdate AS k_ship, l_extendedprice AS k_price")

FIXTURES = {
    "catalogue": """
SELECT p_partkey AS bundle_id, p_name AS course_name,
 CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS subject,
 'L' || CAST(p_size % 3 AS STRING) AS level, 'sa' AS language, 'T' || CAST(p_size % 6 AS STRING) AS texts,
 p_type AS type, p_type AS course_type,
 CASE WHEN p_size % 5 = 0 THEN 'Learning Path' ELSE 'Course' END AS course_division,
 'D' || CAST(p_size % 4 AS STRING) AS division,
 CASE WHEN p_partkey % 7 = 0 THEN 'True' END AS viniyoga,
 CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS certificate, CAST(NULL AS STRING) AS course_sponsor,
 CASE p_size % 4 WHEN 0 THEN 'Completed' WHEN 1 THEN 'Ongoing' WHEN 2 THEN 'Upcoming' END AS status,
 CAST(p_size AS STRING) AS number_of_lectures, CAST(p_size % 9 AS STRING) AS duration,
 'P' || CAST(p_size % 7 AS STRING) AS personas,
 CASE p_partkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' END AS sss_category,
 CASE p_partkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' END AS adhyayanam_category,
 CASE p_size % 3 WHEN 0 THEN 'Short' WHEN 1 THEN 'Mid' ELSE 'Long' END AS term_of_course,
 CASE p_partkey % 4 WHEN 0 THEN 'Top' WHEN 1 THEN 'Middle' WHEN 2 THEN 'Bottom' END AS position_in_funnel,
 CAST(p_size AS INT) AS num_students, CAST(p_partkey AS STRING) AS course_ids, p_retailprice AS price
FROM {part}""",
    "batches": f"""
SELECT {bundle_of('s.s_suppkey')} AS bundle_id,
 'Course ' || CAST({bundle_of('s.s_suppkey')} AS STRING) AS bundle_name, s.s_suppkey AS batch_id,
 CASE WHEN s.s_suppkey % 17 = 0 THEN 'Test batch ' || s.s_name WHEN s.s_suppkey % 19 = 0 THEN 'test old BATCH'
      WHEN s.s_suppkey % 23 = 0 THEN NULL ELSE s.s_name END AS batch_name,
 CASE WHEN s.s_suppkey % 2 = 0 THEN 'Archived' ELSE 'Active' END AS batch_status,
 CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE CAST(a.d0 AS DATE) END AS start_date, CAST(a.d1 AS DATE) AS end_date,
 CAST(s.s_nationkey AS BIGINT) AS tutor_id, s.s_name AS tutor_name,
 CAST(CASE WHEN s.s_suppkey % 13 = 0 THEN 0 ELSE a.n END AS INT) AS admitted_students
FROM {{supplier}} s LEFT JOIN (SELECT l_suppkey, min(l_shipdate) d0, max(l_shipdate) d1, count(DISTINCT l_orderkey) n
                           FROM {{lineitem}} GROUP BY l_suppkey) a ON s.s_suppkey = a.l_suppkey""",
    "lifecycle": f"""
SELECT {bundle_of('s_suppkey')} AS course_id, s_name AS batch_name,
 CASE s_nationkey % 3 WHEN 0 THEN 'New' WHEN 1 THEN 'Repeat' END AS type_of_launch,
 DATE '2020-01-01' + CAST(s_nationkey % 4 AS INT) AS first_class_date,
 DATE '2020-06-01' + CAST(s_nationkey % 4 AS INT) AS last_class_date,
 CAST(s_nationkey % 4 * 10 AS INT) AS enrollments_on_fc, CAST(s_nationkey % 4 * 7 AS INT) AS enrollments_on_lc,
 CAST(s_nationkey % 4 AS DECIMAL(8,2)) AS avg_attendance, CAST(s_nationkey % 4 * 3 AS INT) AS total_certified,
 CAST(s_nationkey % 5 AS DECIMAL(3,2)) AS overall_rating
FROM {{supplier}}""",
    "users": f"""
SELECT c_custkey AS user_id, {email_of('c_custkey', 'c_mktsegment')} AS email,
 CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS full_name, n_name AS state, c_mktsegment AS segment
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "attendance": f"""
SELECT o_custkey AS student_id, l_suppkey AS batch_id, 'Batch ' || CAST(l_suppkey AS STRING) AS batch_name,
 CAST(l_suppkey * 1000 + (year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT) AS class_id,
 CAST({bundle_of('l_suppkey')} AS BIGINT) AS bundle_id,
 CAST({bundle_of('l_suppkey')} + CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END AS BIGINT) AS other_bundle_id,
 'Course ' || CAST({bundle_of('l_suppkey')} AS STRING) AS bundle_name,
 CAST(date_trunc('month', l_shipdate) AS DATE) AS class_date_parsed,
 CASE WHEN l_linenumber = 7 THEN '-' WHEN l_returnflag = 'N' THEN 'P' WHEN l_returnflag = 'R' THEN 'L' ELSE 'A' END
  AS attendance_status,
 CAST(l_suppkey * 10 + l_linenumber AS BIGINT) AS attendance_id, CAST(l_suppkey % 50 AS BIGINT) AS teacher_id,
 'Teacher ' || CAST(l_suppkey % 50 AS STRING) AS teacher_name, CAST(l_linenumber AS STRING) || ' hours' AS class_duration,
 CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linestatus END AS student_comments,
 CAST(l_linenumber % 5 AS INT) AS student_rating, CAST(l_shipdate AS DATE) AS pull_date,
 CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN 'u' || CAST(o_custkey AS STRING) || '@STAFF.example'
      ELSE 'u' || CAST(o_custkey AS STRING) || '@mail.example' END AS student_email,
 {_SEQ_COLUMNS}
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "transactions": f"""
SELECT 'tx-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
  AS event_id, o_custkey AS user_id, {email_of('c_custkey', 'c_mktsegment')} AS email,
 CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE c_name END AS full_name,
 CAST({bundle_of('l_suppkey')} AS BIGINT) AS bundle_id,
 'Course ' || CAST({bundle_of('l_suppkey')} % 1000 AS STRING) AS course_name,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS master_batch_id,
 CASE WHEN l_linenumber = 2 THEN NULL ELSE 'Batch ' || CAST(l_suppkey AS STRING) END AS master_batch_name,
 CASE WHEN l_returnflag = 'N' THEN 'webhook' WHEN l_returnflag = 'R' THEN 'csv' ELSE 'csv.import' END AS source,
 CASE WHEN l_linenumber = 3 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS final_price,
 CASE WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date,
 CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN NULL ELSE o_orderdate END AS created_at,
 {_SEQ_COLUMNS}
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey""",
    # What every message says, in plain columns; the messages themselves are written from these.
    "said": """
SELECT event_id AS e, event_id AS seq, EPOCH(ts) AS received_epoch, ts, user_id AS u, event_type, value, props FROM {events}
UNION ALL
SELECT event_id AS e, event_id + 1000000000 AS seq, EPOCH(ts) + 3600 AS received_epoch, ts, user_id + 1 AS u, event_type,
 value, props FROM {events} WHERE event_id % 10 = 0""",
    "messages": f"""
SELECT e, seq, received_epoch, u, EPOCH(ts) AS ep, e % 3 = 0 AS nested, e % 97 = 5 AS broken,
 e % 89 = 1 AND e % 3 <> 0 AS no_id, e % 11 <> 0 AS live,
 CASE event_type
  WHEN 'signup' THEN CASE WHEN e % 2 = 0 THEN 'user.user_created' ELSE 'user.user_updated' END
  WHEN 'purchase' THEN CASE WHEN e % 4 = 3 THEN 'transaction.user_purchase_failed'
                            ELSE 'transaction.user_purchase_completed' END
  WHEN 'view' THEN CASE e % 5 WHEN 0 THEN 'session.session_created' WHEN 1 THEN 'session.session_started'
                   WHEN 2 THEN 'session.session_update' WHEN 3 THEN 'session.session_cancel' ELSE 'user.user_updated' END
  WHEN 'click' THEN CASE e % 7 WHEN 0 THEN 'assessments.test_submitted' WHEN 1 THEN 'assessments.test_evaluated'
                    WHEN 2 THEN 'course.user_course_completed' WHEN 3 THEN 'announcement.announcement_created'
                    WHEN 4 THEN 'certificate.certificate_issued' WHEN 5 THEN 'user.user_created'
                    ELSE 'assessments.exercise_evaluated' END
  ELSE CASE e % 3 WHEN 0 THEN 'url.validate' WHEN 1 THEN 'manual.test' END END AS etype,
 REPLACE(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '+00:00' AS iso,
 CAST(value AS DECIMAL(12,2)) AS v,
 CASE WHEN e % 5 = 0 THEN NULL ELSE 'm' || CAST(u AS STRING) || '.' || CAST(e % 4 AS STRING) || '@mail.example' END AS email,
 CASE WHEN e % 7 = 0 THEN NULL ELSE 'Name ' || CAST(u AS STRING) || ' ' || CAST(e % 3 AS STRING) END AS person,
 e % 4 AS shape, 'City ' || CAST(e % 40 AS STRING) AS city, 'Parent ' || CAST(e % 30 AS STRING) AS parent,
 CAST(560000 + e % 100 AS STRING) AS pin, {bundle_of('u')} AS b, u * 2 AS m, e % 31 = 0 AS no_user,
 e % 41 = 0 AS bad_mark, CAST(e % 4 AS INT) AS st
FROM (SELECT * FROM said) said_rows""",
    # Everything a message's receiver can know, after the envelope rules.
    "heard": """
SELECT *, CASE WHEN broken THEN NULL WHEN nested THEN COALESCE(etype, 'None') || '-' || iso
               WHEN NOT no_id THEN 'ev-' || CAST(e AS STRING) END AS eid,
 CASE WHEN broken THEN 'Not JSON' WHEN NOT nested AND no_id THEN 'No ID' WHEN etype IS NULL THEN 'Bronze fail' END AS reason
FROM messages""",
    "logged": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY seq) AS copy_no FROM heard WHERE reason IS NULL) ranked
WHERE copy_no = 1""",
    # The same record as text in the layouts found in exports and replies.
    "texts": """
SELECT l_orderkey * 8 + l_linenumber AS row_key, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
 CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS quantity, EPOCH(l_shipdate) AS ship_epoch
FROM {lineitem}""",
}

#: Fixtures that read other fixtures.
NEEDS = {"messages": ("said",), "heard": ("said", "messages"), "logged": ("said", "messages", "heard")}

_EPOCH = re.compile(r"EPOCH\((\w+)\)")


def _spark_sql(text: str) -> str:
    return _EPOCH.sub(r"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', date_trunc('second', \1))", text)


def _duckdb_sql(text: str) -> str:
    return _EPOCH.sub(r"date_diff('second', TIMESTAMP '1970-01-01 00:00:00', date_trunc('second', \1))", text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ITEMS_OF_ORDERS = "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
_BOUGHT = f"{_ITEMS_OF_ORDERS} JOIN {{customer}} ON o_custkey = c_custkey"
#: Spark deals the bought items by customer before they grow to whole rows, so many to a task; what groups them by learner
#: and more then needs no other shuffle.
_BY_CUSTOMER = ("FROM (SELECT /*+ REPARTITION({tasks}, o_custkey) */ * {joined}) bought "
                "JOIN {{customer}} ON o_custkey = c_custkey")

#: Bytes of a given table's file that one task shapes or writes.
_SHARE = 1 << 20


def shares(spark: SparkSession, sf_dir: str, name: str, share: int = _SHARE, least: int = 4) -> int:
    """Tasks for work on a given table, by the size of its file, so that each sees as much however large the table is."""
    return max(least, -(-bytes_below(spark, f"{sf_dir}/{name}.parquet") // share))


def fixture(spark: SparkSession, sf_dir: str, name: str, by_customer: bool = False, dealt: tuple[str, str] | None = None,
            share: int = _SHARE // 2) -> DataFrame:
    """The fixture's rows; ``dealt`` names a table and its key by which rows are dealt out before they are shaped, each task ``share`` bytes of the file."""
    text = _spark_sql(FIXTURES[name])
    for inner in reversed(NEEDS.get(name, ())):
        text = re.sub(rf"\bFROM {inner}\b", f"FROM ({_spark_sql(FIXTURES[inner])}) {inner}", text)
    if by_customer:
        text = text.replace(_BOUGHT, _BY_CUSTOMER.format(tasks=shares(spark, sf_dir, "lineitem", 2 << 20), joined=_ITEMS_OF_ORDERS))
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if dealt is not None:
        t, key = dealt
        used[t] = used[t].repartition(shares(spark, sf_dir, t, share), key)
    return spark.sql(text, **used)


def oracle(body: str, *names: str, **ctes: str) -> str:
    """Oracle text: the named fixtures (and further expressions) as CTEs before ``body``."""
    parts: dict[str, str] = {}
    for name in names:
        for needed in (*NEEDS.get(name, ()), name):
            text = _duckdb_sql(FIXTURES[needed])
            for t in TABLES:
                text = text.replace("{" + t + "}", t)
            parts[f"fx_{needed}" if needed not in ("said", "messages", "heard", "logged") else needed] = text
    parts.update(ctes)
    with_part = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    if body.lstrip().startswith("WITH "):
        body = f"SELECT * FROM ({body}) nested"
    return f"WITH {with_part}\n{body}" if parts else body
