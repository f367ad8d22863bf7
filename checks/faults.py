"""Awkward input: values out of range, repeated keys, odd files, changes to stored tables, retries, pull by pull loads."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from checks import attendance as attendance_checks
from checks.attendance import _summary_sql
from checks.common import fold_sql, query
from checks.courses import _CLEAN, _RAW_CTE, _STUDENTS, _WHOLE_ID, raw_catalogue
from checks.entities import _BACKFILL_FIRST, KEYS, purchases
from checks.fixtures import SEQ, fixture, oracle, shares, table
from tutorlake import session
from tutorlake.functions.jsonfields import text_at, typed_at
from tutorlake.operators import predicates, upsert
from tutorlake.operators.totals import total_before
from tutorlake.operators.policies import TRANSACTIONS, TRANSACTIONS_BACKFILL, TRANSACTIONS_INSERT_ONLY
from tutorlake.plans import attendance, courses, gold, quality, reports
from tutorlake.plans.attendance_store import AttendanceStore
from tutorlake.sources import csvfiles, pages, sinks
from tutorlake.streaming.runner import EventPipeline, read_messages


# --- events -----------------------------------------------------------------


def _certificates(spark, sf_dir) -> DataFrame:
    """Certificate messages: sound ones, and five kinds of odd value."""
    event, kind = F.col("event_id"), F.col("event_id") % 7
    stamp = F.lit(1700000000) + event % 1000000
    data = (F.when(kind == 1, F.format_string('{"certificate_id":"c%d","user_id":1,"issued_at":%d000000}', event, stamp))
            .when(kind == 2, F.format_string('{"certificate_id":"c%d","user_id":1,"issued_at":%d000}', event, stamp))
            .when(kind == 4, F.format_string('{"certificate_id":"old","user_id":1,"issued_at":%d,"certificate_id":"c%d"}', stamp, event))
            .when(kind == 5, F.format_string('{"certificate_id":"c%d","user_id":99999999999999999999,"issued_at":%d}', event, stamp))
            .when(kind == 6, F.format_string('{"certificate_id":"c%d","user_id":1,"issued_at":"soon"}', event))
            .otherwise(F.format_string('{"certificate_id":"c%d","user_id":1,"issued_at":%d}', event, stamp)))
    body = F.format_string('{"id":"e%d","event_name":"certificate.certificate_issued","event_timestamp":%s,"data":%s}',
                           event, F.when(kind == 3, F.concat(stamp.cast("string"), F.lit("000000"))).otherwise(stamp.cast("string")), data)
    return table(spark, sf_dir, "events").select(
        event.alias("seq"), F.timestamp_seconds(stamp).alias("received_at"), F.lit("application/json").alias("content_type"),
        body.alias("body"))


def _pipeline(spark, label: str) -> EventPipeline:
    return EventPipeline(spark, session.scratch_path(spark, label), buckets=4)


@query("events_bad_values", """
SELECT 'e' || CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 7 NOT IN (0, 4) THEN 'bad value' END AS problem,
 CASE WHEN event_id % 7 IN (0, 4) THEN 'c' || CAST(event_id AS VARCHAR) END AS certificate_id FROM events""")
def _(spark, sf_dir):
    pipeline = _pipeline(spark, "bad-values")
    pipeline.process(_certificates(spark, sf_dir), 0)
    kept = pipeline.table("certificates").read().select("event_id", F.lit(None).cast("string").alias("problem"), "certificate_id")
    return kept.unionByName(pipeline.retry().select("event_id", "problem", F.lit(None).cast("string").alias("certificate_id")))


@query("events_retry_recovers", """
SELECT 'certificates' AS place, count(*) FILTER (WHERE event_id % 7 <> 1) AS n FROM events
UNION ALL SELECT 'queue', count(*) FILTER (WHERE event_id % 7 = 1) FROM events""")
def _(spark, sf_dir):
    """Open events enter their table with a later micro-batch once their data can be read."""
    pipeline = _pipeline(spark, "retries")
    pipeline.process(_certificates(spark, sf_dir), 0)
    # The queue is mended by hand, as an operator would: all but the events with microseconds.
    sound = F.format_string('{"certificate_id":"c%d","user_id":1}', F.col("seq"))
    pipeline.mend(pipeline.retry().withColumn("data", F.when(F.col("seq") % 7 == 1, F.col("data")).otherwise(sound)).withColumn(
        "event_epoch", F.when(F.col("seq") % 7 == 3, F.lit(None)).otherwise(F.col("event_epoch"))))
    pipeline.process(_certificates(spark, sf_dir).limit(0), 1)
    counts = [pipeline.table("certificates").read().agg(F.count("*").alias("n")).select(F.lit("certificates").alias("place"), "n"),
              pipeline.retry().agg(F.count("*").alias("n")).select(F.lit("queue").alias("place"), "n")]
    return counts[0].unionByName(counts[1])


# --- files ------------------------------------------------------------------


def _led(lines: DataFrame, lead: list[str], key: str, path: str) -> None:
    """Lines as files that follow a key, each of them after the same lead."""
    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": lead})
        yield from batches

    lines.repartitionByRange(4, key).sortWithinPartitions(key).select("value").mapInPandas(begin, "value string").write.text(path)


@query("csv_header_with_line_break", """
SELECT s_suppkey - (SELECT min(s_suppkey) FROM supplier) AS source_row, CAST(s_suppkey AS VARCHAR) AS a_x, s_name AS b FROM supplier""")
def _(spark, sf_dir):
    path = session.scratch_path(spark, "broken-header")
    lines = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat_ws(",", "s_suppkey", "s_name").alias("value"))
    _led(lines, ['"a', 'x",b'], "s_suppkey", path)
    read = csvfiles.read_csv_dynamic(spark, path)
    return read.select("source_row", F.col(read.columns[1]).alias("a_x"), F.col(read.columns[2]).alias("b"))


@query("csv_record_equal_to_header", """
SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS source_row, CASE WHEN s_suppkey % 10 = 3 THEN 'Name' ELSE s_name END AS name,
 CASE WHEN s_suppkey % 10 = 3 THEN 'Email' ELSE 'm' || CAST(s_suppkey AS VARCHAR) END AS email FROM supplier""")
def _(spark, sf_dir):
    path = session.scratch_path(spark, "repeated-header")
    key = F.col("s_suppkey")
    line = F.when(key % 10 == 3, F.lit("Name,Email")).otherwise(F.concat(F.col("s_name"), F.lit(",m"), key.cast("string")))
    _led(table(spark, sf_dir, "supplier").select(key, line.alias("value")), ["Exported today", "Name,Email"], "s_suppkey", path)
    return csvfiles.read_csv_mapped(spark, path, {"Name": "name", "Email": "email"}, skip_lines=1)


@query("pages_rejects", """
SELECT count(*) FILTER (WHERE s_suppkey % 4 = 1) AS broken, count(*) FILTER (WHERE s_suppkey % 4 = 2) AS large,
 count(*) FILTER (WHERE s_suppkey % 4 IN (0, 3)) AS read_rows FROM supplier""")
def _(spark, sf_dir):
    """Pages as lines; the size above which a page counts as too large is lowered, so that small ones show the reason."""
    path, key = session.scratch_path(spark, "pages"), F.col("s_suppkey")
    page = (F.when(key % 4 == 1, F.concat(F.lit('{"data": ['), key.cast("string")))
            .when(key % 4 == 2, F.concat(F.lit('{"data": ["'), F.repeat(F.lit("x"), 5000)))
            .when(key % 4 == 3, F.concat(F.lit('{"data": [{"a": 1, "a": '), key.cast("string"), F.lit("}]}")))
            .otherwise(F.concat(F.lit('{"data": [{"a": '), key.cast("string"), F.lit("}]}"))))
    table(spark, sf_dir, "supplier").select(page.alias("value")).write.text(path)
    landed = pages.read_pages(spark, path, one_per_line=True)
    outcomes = pages.page_rejects(landed, limit=1000).select("reason").unionByName(
        pages.unwrap_rows(landed, "page").select(F.lit("read").alias("reason")))
    return outcomes.agg(
        F.count_if(F.col("reason") == pages.NOT_JSON).alias("broken"), F.count_if(F.col("reason") == pages.TOO_LARGE).alias("large"),
        F.count_if(F.col("reason") == "read").alias("read_rows"))


@query("pages_large", """
SELECT s_suppkey AS id, s_name AS name, CAST(s_suppkey % 50 AS INT) AS pos FROM supplier""")
def _(spark, sf_dir):
    """Pages of fifty rows, read as if a value could hold a thousand bytes: each is cut by its structure and gives all rows."""
    path, key = session.scratch_path(spark, "large-pages"), F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.floor(key / 50).alias("page_no"), key.alias("id"), F.to_json(F.struct(
        key.alias("id"), F.col("s_name").alias("name"), F.concat(F.col("s_name"), F.lit('},{"a":["')).alias("note"))).alias("row"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("id", "row"))), lambda r: r["row"])
    whole = F.concat(F.lit('{"code":0,"data":['), F.array_join(listed, ", "), F.lit('],"page_context":{"has_more_page":false}}'))
    rows.groupBy("page_no").agg(whole.alias("value")).repartition("page_no").write.partitionBy("page_no").text(path)
    read = pages.unwrap_rows(pages.read_pages(spark, path, limit=1000))
    return read.select(typed_at(F.col("row"), "bigint", "id").alias("id"), text_at(F.col("row"), "name").alias("name"), "pos")


# --- changes to stored tables -----------------------------------------------

_STORED = ["event_id", "event_type", "event_timestamp", "email", "full_name", "course_name", "master_batch_name", "original_price",
           "discount", "currency", "final_price", "source"]
_WEB_FIRST = ["event_type", "event_timestamp", "email", "full_name", "course_name", "master_batch_name", "original_price", "discount",
              "currency"]
_BOUGHT = """SELECT *, 'transaction.user_purchase_completed' AS event_type, created_at AS event_timestamp, final_price AS original_price,
 final_price - final_price AS discount, 'INR' AS currency, source = 'webhook' AS web FROM fx_transactions"""
_WEB = fold_sql("(SELECT * FROM bought WHERE web)", KEYS, SEQ, first=_WEB_FIRST, last=["event_id", "final_price", "source"])


def _on_webhook(filled: bool) -> str:
    past = fold_sql("(SELECT * FROM bought WHERE NOT web)", KEYS, SEQ, first=[*_BACKFILL_FIRST, "event_type"] + ([] if filled else ["email", "full_name"]),
                    first_value=["email", "full_name"] if filled else [])
    own = {c: f"coalesce(w.{c}, p.{c})" if filled and c in ("email", "full_name") else f"w.{c}" for c in _STORED}
    new = {c: f"p.{c}" if c in ("event_id", "event_type", "course_name", "master_batch_name", "source", "email", "full_name") else "NULL"
           for c in _STORED}
    same = " AND ".join(f"w.{k} = p.{k}" for k in KEYS)
    return oracle(f"""
SELECT {', '.join('w.' + k for k in KEYS)}, {', '.join(f'{v} AS {c}' for c, v in own.items())}, CAST(NULL AS DATE) AS start_date
FROM web w LEFT JOIN past p ON {same}
UNION ALL SELECT {', '.join('p.' + k for k in KEYS)}, {', '.join(f'{v} AS {c}' for c, v in new.items())}, p.start_date
FROM past p WHERE NOT EXISTS (SELECT 1 FROM web w WHERE {same})""", "transactions", bought=_BOUGHT, web=_WEB, past=past)


def _backfilled(spark, sf_dir, rule) -> DataFrame:
    rows = purchases(spark, sf_dir)
    there = upsert.fold(rows.filter("source = 'webhook'"), TRANSACTIONS.keys, SEQ, TRANSACTIONS.policies)
    state = upsert.apply(session.stored(there, "transactions"), rows.filter("source <> 'webhook'"), rule.keys, SEQ, rule.policies)
    return state.select(*KEYS, *_STORED, "start_date")


@query("transactions_backfill_on_webhook", _on_webhook(True))
def _(spark, sf_dir):
    return _backfilled(spark, sf_dir, TRANSACTIONS_BACKFILL)


@query("transactions_insert_only_on_webhook", _on_webhook(False))
def _(spark, sf_dir):
    return _backfilled(spark, sf_dir, TRANSACTIONS_INSERT_ONLY)


_TYPED = f"""SELECT source_row, {_WHOLE_ID} AS bundle_id, {_CLEAN.format(c='course_name')} AS course_name,
 {_CLEAN.format(c='subject')} AS subject, status, {_STUDENTS} AS num_students,
 CASE WHEN cost <> '#VALUE!' THEN CAST(replace(cost, ',', '') AS DOUBLE) END AS cost FROM raw WHERE {_WHOLE_ID} IS NOT NULL"""
_HALF = "(SELECT * FROM fx_catalogue WHERE bundle_id % 4 <> 2)"


def _half(spark, sf_dir) -> DataFrame:
    """A stored catalogue that lacks every fourth course."""
    return session.stored(fixture(spark, sf_dir, "catalogue").filter("bundle_id % 4 <> 2"), "catalogue")


@query("catalogue_csv_on_stored", oracle(f"""
SELECT c.* REPLACE (if(p.bundle_id IS NULL, c.course_name, p.course_name) AS course_name, if(p.bundle_id IS NULL, c.status, p.status) AS status,
 if(p.bundle_id IS NULL, c.num_students, p.num_students) AS num_students) FROM {_HALF} c LEFT JOIN changes p ON p.bundle_id = c.bundle_id
UNION ALL BY NAME SELECT bundle_id, course_name, subject, status, num_students FROM changes WHERE bundle_id NOT IN (SELECT bundle_id FROM {_HALF} h)""",
    "catalogue", **_RAW_CTE, typed=_TYPED,
    changes=fold_sql("typed", ["bundle_id"], ["source_row"], first=["subject"], last=["course_name", "status", "num_students"])))
def _(spark, sf_dir):
    return courses.catalogue_from_csv(raw_catalogue(spark, sf_dir), _half(spark, sf_dir))


@query("catalogue_insert_on_stored", oracle(f"""
SELECT c.*, CAST(NULL AS DOUBLE) AS cost FROM {_HALF} c
UNION ALL BY NAME SELECT bundle_id, course_name, cost FROM changes WHERE bundle_id NOT IN (SELECT bundle_id FROM {_HALF} h)""",
    "catalogue", **_RAW_CTE, typed=_TYPED, changes=fold_sql("typed", ["bundle_id"], ["source_row"], first=["course_name", "cost"])))
def _(spark, sf_dir):
    return courses.catalogue_insert_only(raw_catalogue(spark, sf_dir), _half(spark, sf_dir))


# --- attendance, pull by pull ------------------------------------------------

_DAYS = ("1996-03-13", "1997-05-05", "1998-06-01")
#: Three loads that deal every row by ranges of dates; without a date it is in the first.
_RANGES = [f"SELECT * FROM fx_attendance WHERE pull_date <= DATE '{_DAYS[0]}' OR pull_date IS NULL",
           f"SELECT * FROM fx_attendance WHERE pull_date > DATE '{_DAYS[0]}' AND pull_date <= DATE '{_DAYS[1]}'",
           f"SELECT * FROM fx_attendance WHERE pull_date > DATE '{_DAYS[1]}'"]


def _chain_sql(pulled: list[str]) -> str:
    """Raw rows of the loads, the first load's dates in order; each date's rows keep the identity first seen."""
    seen = " UNION ALL ".join(f"SELECT *, {i} AS load FROM ({text}) r{i}" for i, text in enumerate(pulled))
    last = "pull_date attendance_status".split()
    first = "batch_id batch_name bundle_id bundle_name class_date_parsed attendance_id teacher_id teacher_name class_duration".split()
    identity = fold_sql("(SELECT * FROM seen WHERE NOT staff)", ["student_id", "class_id"], ["load", "pull_date", *SEQ], first=first)
    latest = fold_sql("(SELECT * FROM seen WHERE NOT staff)", ["student_id", "class_id", "load"], ["pull_date", *SEQ], last=last)
    current = f"SELECT l.*, {', '.join('i.' + c for c in first)} FROM latest l JOIN identity i USING (student_id, class_id)"
    per_pull = _summary_sql("current")
    # Within the first load a class is summarised for every date on which its marks were last changed.
    picked = "SELECT * FROM per_pull QUALIFY row_number() OVER (PARTITION BY batch_id, class_id, pull_date ORDER BY bundle_id) = 1"
    kept = fold_sql("picked", ["batch_id", "class_id"], ["pull_date"], first=["bundle_id"],
                    last=["class_date", "present_count", "late_count", "absent_count", "total_records", "attendance_pct", "pull_date"])
    return oracle("""
SELECT batch_id, class_id, bundle_id, class_date, present_count, late_count, absent_count, total_records, attendance_pct, pull_date,
 CAST(row_number() OVER (PARTITION BY batch_id ORDER BY class_date, class_id) AS INT) AS class_number FROM kept""",
                  "attendance", seen=f"SELECT *, coalesce(lower(student_email) LIKE '%@staff%', FALSE) AS staff FROM ({seen}) s",
                  identity=identity, latest=latest, current=current, per_pull=per_pull, picked=picked, kept=kept)


def _chained(spark, loads: list[DataFrame]) -> DataFrame:
    store = AttendanceStore(spark, session.scratch_path(spark, "attendance"), buckets=8, fan_in=2, days=64)
    for number, load in enumerate(loads):
        store.load(load, F.timestamp_seconds(F.lit(1700000000 + number)), number)
    return store.classes.read().select("batch_id", "class_id", "bundle_id", "class_date", "present_count", "late_count", "absent_count",
                                       "total_records", "attendance_pct", "pull_date", "class_number")


@query("attendance_chain_all_pulls", _chain_sql(_RANGES))
def _(spark, sf_dir):
    """Three loads one after the other, each into the tables that the one before left."""
    rows = attendance_checks.raw(spark, sf_dir).withColumn("is_staff", predicates.staff_at_ingest(F.col("student_email")))
    day, (first, second) = F.col("pull_date"), (F.lit(d).cast("date") for d in _DAYS[:2])
    return _chained(spark, [rows.filter((day <= first) | day.isNull()), rows.filter((day > first) & (day <= second)), rows.filter(day > second)])


# --- results whose order counts, and the smaller sinks ------------------------


def _placed(df: DataFrame) -> DataFrame:
    """The rows with their place in the result's order: the place inside a partition after the rows of those before."""
    at = session.stored(df.withColumn("__at", F.monotonically_increasing_id()), "placed").withColumn("__n", F.lit(1))
    return total_before(at, ["__at"], "__n", "place").drop("__at", "__n")


@query("report_order", oracle("""
SELECT row_number() OVER (ORDER BY n DESC, label) - 1 AS place, label, n FROM (
 SELECT coalesce(subject, '(not set)') AS label, count(*) AS n FROM fx_catalogue GROUP BY 1) counted""", "catalogue"))
def _(spark, sf_dir):
    return _placed(reports.breakdown(fixture(spark, sf_dir, "catalogue"), F.col("subject")))


@query("attendance_years_in_order", oracle("""
SELECT row_number() OVER (ORDER BY attendance_year) - 1 AS place, attendance_year FROM (
 SELECT DISTINCT CAST(year(class_date) AS INT) AS attendance_year FROM classes) years""", "attendance", **attendance_checks.CLASSES_CTES))
def _(spark, sf_dir):
    return _placed(gold.attendance_by_year(attendance_checks.classes(spark, sf_dir)).select("attendance_year"))


@query("csv_missing_and_invalid", """
SELECT s_suppkey - (SELECT min(s_suppkey) FROM supplier) AS source_row, chr(65533) || s_name AS name, CAST(0 AS BIGINT) AS missing FROM supplier""")
def _(spark, sf_dir):
    """Bytes that are no UTF-8 are read as the replacement character; a missing file has no rows."""
    path = session.scratch_path(spark, "invalid")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("\u00ff"), F.col("s_name")).alias("Name"))
    rows = rows.repartitionByRange(4, "s_suppkey").sortWithinPartitions("s_suppkey").select("Name")
    rows.write.option("encoding", "ISO-8859-1").csv(path, header=True)
    missing = csvfiles.read_students_if_present(spark, f"{path}-none").count()
    return csvfiles.read_csv_mapped(spark, path, {"Name": "name"}).withColumn("missing", F.lit(missing).cast("bigint"))


@query("append_log_only_new", """
SELECT event_id, min(event_id) AS seq FROM (
 SELECT event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id FROM events) e GROUP BY event_id""")
def _(spark, sf_dir):
    """Appending to a log that holds half of the rows, twice, adds each row once."""
    path = session.scratch_path(spark, "log")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("seq"))
    rows.filter("event_id % 2 = 0").write.parquet(path)
    for _ in range(2):
        sinks.append_new(rows.unionByName(rows), spark.read.parquet(path), path, ["event_id"], ["seq"])
    return spark.read.parquet(path)


@query("summary_csv", oracle("""
SELECT CAST(batch_id AS VARCHAR) AS batch_id, CAST(class_id AS VARCHAR) AS class_id, CAST(present_count AS VARCHAR) AS present_count,
 CAST(attendance_pct AS VARCHAR) AS attendance_pct, '2024-01-02' AS loaded_at FROM summary""", "attendance", summary=_summary_sql()))
def _(spark, sf_dir):
    path = session.scratch_path(spark, "summary")
    summary = attendance.summarise(attendance_checks.raw(spark, sf_dir))
    sinks.write_summary_csv(attendance.summary_export(summary, F.lit("2024-01-02")), path)
    return spark.read.csv(path, header=True).select("batch_id", "class_id", "present_count", "attendance_pct", "loaded_at")


@query("events_rebuild", """
SELECT 'e' || CAST(event_id AS VARCHAR) AS event_id, 'c' || CAST(event_id AS VARCHAR) AS certificate_id FROM events
WHERE event_id % 7 IN (0, 4)""")
def _(spark, sf_dir):
    """The table is built anew beside the old one, takes its place, and is then read."""
    pipeline = _pipeline(spark, "rebuild")
    pipeline.process(_certificates(spark, sf_dir), 0)
    pipeline.rebuild_in_place("certificates")
    return pipeline.table("certificates").read().select("event_id", "certificate_id")


@query("events_redelivered_once", """
SELECT 'e' || CAST(event_id AS VARCHAR) AS event_id, event_id AS seq FROM events""")
def _(spark, sf_dir):
    """A stream of many micro-batches in which every message comes again later: the log keeps the first of each."""
    root, rows = session.scratch_path(spark, "redelivered"), _certificates(spark, sf_dir)
    for shift in (0, 10**9):
        rows.withColumn("seq", F.col("seq") + shift).repartitionByRange(3, "seq").write.mode("append").json(f"{root}/landing")
        pipeline = EventPipeline(spark, f"{root}/out", buckets=4)
        pipeline.start(read_messages(spark, f"{root}/landing", files_per_batch=2), f"{root}/checkpoint").awaitTermination()
    return pipeline.events().select("event_id", "seq")


_BUYERS = """SELECT c_custkey AS u, c_custkey % 5 = 0 AS test_event, c_custkey % 7 = 0 AS test_user FROM customer"""


@query("events_cleanup", f"""
WITH buyers AS ({_BUYERS})
SELECT 'webhook_events' AS place, count(*) FILTER (WHERE NOT test_event) AS n FROM buyers
UNION ALL SELECT 'users', count(*) FILTER (WHERE NOT test_user) FROM buyers
UNION ALL SELECT 'assessments', count(*) FILTER (WHERE NOT test_user) FROM buyers""")
def _(spark, sf_dir):
    """Test rows go from the tables that the pipeline itself wrote; neither a repeated nor a later micro-batch brings them back."""
    key = F.col("c_custkey")
    user = F.when(key % 7 == 0, key + 99990000).otherwise(key).cast("string")
    name = F.concat(F.when(key % 5 == 0, F.lit("e2e-")).otherwise(F.lit("ev-")), key.cast("string"))
    bodies = [F.concat(F.lit('{"id":"'), name, F.lit(f'-{kind}","event_name":"{event}","event_timestamp":1700000000,"data":{{"user_id":'), user, F.lit(f"{more}}}}}"))
              for kind, event, more in (("u", "user.user_created", ',"email":"a@mail.example"'), ("a", "assessments.test_submitted", ',"attempt_id":1'))]
    # Bodies are many times a key's size; a file of one row group would come as one task.
    keys = table(spark, sf_dir, "customer").select("c_custkey").repartition(shares(spark, sf_dir, "customer"))
    rows = keys.select(
        F.posexplode(F.array(*bodies)).alias("place", "body"), key.alias("key")).select(
        (F.col("key") * 2 + F.col("place")).alias("seq"), F.timestamp_seconds(F.lit(1700000000)).alias("received_at"),
        F.lit("application/json").alias("content_type"), "body")
    pipeline = EventPipeline(spark, session.scratch_path(spark, "clean"), buckets=4, fan_in=2)
    pipeline.process(rows, 0)
    pipeline.clean({"webhook_events": predicates.test_event(F.col("event_id")),
                    "users": predicates.test_user(F.col("email"), F.col("user_id")),
                    "assessments": predicates.test_user(None, F.col("user_id"))})
    pipeline.process(rows, 0)
    pipeline.process(rows.limit(0), 1)
    users = [pipeline.log.read().filter(F.col("event_id").endswith("-u")).select(F.lit("webhook_events").alias("place")),
             *[pipeline.table(name).read().select(F.lit(name).alias("place")) for name in ("users", "assessments")]]
    return reports.union_all([part.groupBy("place").agg(F.count("*").alias("n")) for part in users])


@query("events_body_preview_all", """
SELECT event_id AS seq, '{"id":"e' || CAST(event_id AS VARCHAR) AS preview FROM events""")
def _(spark, sf_dir):
    rows = _certificates(spark, sf_dir)
    return rows.select("seq", quality.preview(F.col("body"), 8 + F.length(F.col("seq").cast("string"))).alias("preview"))


_CLEANED = ("bronze.webhook_events", "silver.transactions", "silver.users", "silver.sessions", "silver.assessments", "silver.certificates")


@query("cleanup_all_targets", "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) FILTER (WHERE c_custkey % {5 + i} <> 0) AS rows_after FROM customer"
    for i, name in enumerate(_CLEANED)))
def _(spark, sf_dir):
    """Test rows go from every target and the rows that stay are written back."""
    root, parts = session.scratch_path(spark, "cleanup"), []
    for i, name in enumerate(_CLEANED):
        key = F.col("c_custkey")
        hit = key % (5 + i) == 0
        rows = table(spark, sf_dir, "customer").select(
            F.concat(F.when(hit, F.lit("e2e-")).otherwise(F.lit("ev-")), key.cast("string")).alias("event_id"),
            (key + F.when(hit, F.lit(99990000)).otherwise(F.lit(0))).alias("user_id"),
            F.concat(F.when(hit & (key % 2 == 0), F.lit("test")).otherwise(F.lit("u")), key.cast("string"), F.lit("@mail.example")).alias("email"))
        found = {"bronze.webhook_events": predicates.test_event(F.col("event_id")),
                 "silver.users": predicates.test_user(F.col("email"), F.col("user_id")),
                 "silver.transactions": predicates.test_user(F.col("email"), F.col("user_id"))}
        kept = quality.split_test_rows(rows, found.get(name, predicates.test_user(None, F.col("user_id"))))[1]
        sinks.overwrite(kept, f"{root}/{name}")
        parts.append(spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("rows_after")).select(
            F.lit(name).alias("table_name"), "rows_after"))
    return reports.union_all(parts)
