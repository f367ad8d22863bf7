"""Upserts of the entity tables and the event pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.common import fold_sql, query
from checks.fixtures import SEQ, SEQ_SQL, fixture, oracle
from checks.messages import messages
from tutorlake import session
from tutorlake.operators import dedup, envelope, upsert
from tutorlake.operators.policies import TRANSACTIONS, TRANSACTIONS_BACKFILL, TRANSACTIONS_INSERT_ONLY
from tutorlake.plans import backfill, quality, routing
from tutorlake.streaming.runner import EventPipeline, read_messages, replay

KEYS = ["user_id", "bundle_id", "master_batch_id"]


def purchases(spark, sf_dir) -> DataFrame:
    none = F.lit(None).cast("string")
    return fixture(spark, sf_dir, "transactions", by_customer=True).withColumns({
        "event_type": F.lit("transaction.user_purchase_completed"), "event_timestamp": F.col("created_at"),
        "original_price": F.col("final_price"), "discount": F.col("final_price") - F.col("final_price"),
        "currency": F.lit("INR"), "institution_bundle_id": none, "end_date": F.col("start_date"),
    })


_FIRST = ["email", "full_name", "course_name", "master_batch_name"]
_SHOWN = [*KEYS, "event_id", "final_price", "source", *_FIRST]


@query("transactions_upsert_webhook", oracle(
    fold_sql("fx_transactions", KEYS, SEQ, first=_FIRST, last=["event_id", "final_price"], extra=", 'webhook' AS source"),
    "transactions"))
def _(spark, sf_dir):
    changes = purchases(spark, sf_dir).withColumn("source", F.lit("webhook"))
    return upsert.fold(changes, TRANSACTIONS.keys, SEQ, TRANSACTIONS.policies).select(_SHOWN)


@query("transactions_null_key_append", oracle("""
SELECT user_id, COUNT(*) AS kept, MIN(event_id) AS first_event FROM fx_transactions WHERE master_batch_id IS NULL
GROUP BY user_id""", "transactions"))
def _(spark, sf_dir):
    state = upsert.fold(purchases(spark, sf_dir), TRANSACTIONS.keys, SEQ, TRANSACTIONS.policies)
    lone = state.filter(F.col("master_batch_id").isNull())
    return lone.groupBy("user_id").agg(F.count("*").alias("kept"), F.min("event_id").alias("first_event"))


_BACKFILL_FIRST = ["event_id", "course_name", "master_batch_name", "source", "start_date"]


@query("transactions_upsert_csv_keep_existing", oracle(
    fold_sql("staged", KEYS, ["stage", *SEQ], first=_BACKFILL_FIRST, first_value=["email", "full_name"]),
    "transactions", staged="SELECT *, CASE WHEN source = 'webhook' THEN 0 ELSE 1 END AS stage FROM fx_transactions"))
def _(spark, sf_dir):
    rows, rule = purchases(spark, sf_dir), TRANSACTIONS_BACKFILL
    # What is there already went through the same rule; the historical rows come on top.
    there = session.stored(upsert.fold(rows.filter("source = 'webhook'"), rule.keys, SEQ, rule.policies), "transactions")
    state = upsert.apply(there, rows.filter("source <> 'webhook'"), rule.keys, SEQ, rule.policies)
    return state.select(*KEYS, *_BACKFILL_FIRST, "email", "full_name")


#: Enrolment export: every cell text, record order as a text number.
_ENROLMENTS = f"""
SELECT CAST(k_order AS STRING) || ':' || CAST(k_line AS STRING) || ':' || CAST(k_part AS STRING) || ':' || CAST(k_supp AS STRING)
 || ':' || CAST(CAST(k_ship AS DATE) AS STRING) || ':' || CAST(CAST(k_price AS DECIMAL(12,2)) AS STRING) AS source_row,
 CASE WHEN k_line = 6 AND k_supp % 2 = 0 THEN '0' WHEN k_line = 6 THEN NULL ELSE ' ' || CAST(user_id AS STRING) END AS user_id,
 full_name AS name, CASE WHEN k_line = 1 THEN upper(email) || ' ' ELSE email END AS email,
 CAST(bundle_id AS STRING) AS bundle_id, course_name AS class_name,
 CASE WHEN master_batch_id IS NULL THEN 'None' ELSE CAST(master_batch_id AS STRING) END AS master_batch_id, master_batch_name,
 CASE WHEN k_line = 2 THEN '' ELSE '363' END AS institution_bundle_id,
 CAST(EPOCH(k_ship) AS STRING) AS classusers_start_date,
 CASE WHEN k_line = 3 THEN '0' ELSE CAST(EPOCH(k_ship) + 86400 AS STRING) END AS classusers_end_date
FROM {{transactions}}"""
_ENROLMENTS_SPARK = _ENROLMENTS.replace(
    "EPOCH(k_ship)", "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', k_ship)")
_ENROLMENTS_CTE = {"enrolments": _ENROLMENTS.format(transactions="fx_transactions").replace(
    "EPOCH(k_ship)", "date_diff('second', TIMESTAMP '1970-01-01', k_ship)")}


def enrolments(spark, sf_dir) -> DataFrame:
    return spark.sql(_ENROLMENTS_SPARK, transactions=fixture(spark, sf_dir, "transactions"))


def _id_sql(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('', '0', 'None') THEN CAST(trim({c}) AS BIGINT) END"


@query("transactions_insert_only", oracle(
    fold_sql("typed", KEYS, ["source_row"],
             first=["event_id", "full_name", "email", "course_name", "institution_bundle_id", "start_epoch", "end_epoch"],
             extra=", 'csv' AS source, 'csv.import' AS event_type"),
    "transactions", **_ENROLMENTS_CTE, typed=f"""
SELECT source_row, {_id_sql('user_id')} AS user_id, {_id_sql('bundle_id')} AS bundle_id,
 {_id_sql('master_batch_id')} AS master_batch_id, 'csv-enrollment-' || source_row AS event_id, name AS full_name, email,
 class_name AS course_name, {_id_sql('institution_bundle_id')} AS institution_bundle_id,
 {_id_sql('classusers_start_date')} AS start_epoch, {_id_sql('classusers_end_date')} AS end_epoch
FROM enrolments WHERE {_id_sql('user_id')} IS NOT NULL"""))
def _(spark, sf_dir):
    state = backfill.backfill_transactions(enrolments(spark, sf_dir), insert_only=True)
    return state.select(
        *KEYS, "event_id", "event_type", "full_name", "email", "course_name", "institution_bundle_id", "source",
        F.unix_seconds("start_date").alias("start_epoch"), F.unix_seconds("end_date").alias("end_epoch"))


#: Student export: e-mails in mixed case, dates as local text.
_STUDENTS = """
SELECT user_id AS source_row, full_name AS name,
 CASE WHEN user_id % 8 = 3 THEN 'stranger' || CAST(user_id AS STRING) || '@mail.example' WHEN user_id % 2 = 0 THEN upper(email)
  ELSE ' ' || email END AS email, 'login' || CAST(user_id AS STRING) AS username,
 'City ' || CAST(user_id % 9 AS STRING) AS city, state, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'Road' END AS address,
 CASE WHEN user_id % 6 = 0 THEN 'unknown' ELSE CAST(1 + user_id % 12 AS STRING) || '/' || CAST(1 + user_id % 28 AS STRING)
  || '/2021 ' || CAST(user_id % 24 AS STRING) || ':05' END AS date_created
FROM {users}"""
_STUDENTS_CTE = {
    **_ENROLMENTS_CTE,
    "students": _STUDENTS.format(users="fx_users"),
    "email_map": """SELECT lower(trim(email)) AS email_key, MIN(CAST(trim(user_id) AS BIGINT)) AS user_id FROM enrolments
 WHERE email IS NOT NULL AND user_id IS NOT NULL GROUP BY 1""",
}


def students(spark, sf_dir) -> DataFrame:
    return spark.sql(_STUDENTS, users=fixture(spark, sf_dir, "users"))


@query("users_backfill_by_email", oracle(
    fold_sql("matched", ["user_id"], ["source_row"], first=["event_id", "email", "user_name", "city", "state", "address", "created_epoch"],
             first_value=["full_name"], extra=", 'csv.import' AS event_type"),
    "transactions", "users", **_STUDENTS_CTE, matched="""
SELECT s.source_row, m.user_id, 'csv-student-' || CAST(s.source_row AS STRING) AS event_id, s.email, s.name AS full_name,
 s.username AS user_name, s.city, s.state, s.address,
 date_diff('second', TIMESTAMP '1970-01-01', try_strptime(s.date_created, '%m/%d/%Y %H:%M')) - 19800 AS created_epoch
FROM students s JOIN email_map m ON lower(trim(s.email)) = m.email_key"""))
def _(spark, sf_dir):
    state = backfill.backfill_users(students(spark, sf_dir), enrolments(spark, sf_dir))
    return state.withColumn("created_epoch", F.unix_seconds("created_at")).drop("created_at")


@query("users_unresolved", oracle("""
SELECT source_row, email, 'login' || CAST(source_row AS STRING) AS username FROM students
WHERE email IS NOT NULL AND lower(trim(email)) NOT IN (SELECT email_key FROM email_map)""", "transactions", "users", **_STUDENTS_CTE))
def _(spark, sf_dir):
    left = backfill.unresolved_students(students(spark, sf_dir), enrolments(spark, sf_dir))
    return left.select("source_row", "email", F.get_json_object("raw_row", "$.username").alias("username"))


# --- events ----------------------------------------------------------------

def parsed(spark, sf_dir) -> DataFrame:
    return envelope.parse(messages(spark, sf_dir))


def events(spark, sf_dir) -> DataFrame:
    return dedup.first_seen(envelope.accepted(parsed(spark, sf_dir)).withColumn("data", F.to_json("data")),
                            ["event_id"], ["seq"]).withColumn("data", F.parse_json("data"))


@query("events_parse_envelope", oracle("""
SELECT seq, eid AS event_id, CASE WHEN NOT broken THEN etype END AS event_type, CASE WHEN broken THEN TRUE ELSE live END AS is_live,
 CASE WHEN NOT broken THEN ep END AS event_epoch, reason AS reject_reason FROM heard""", "heard"))
def _(spark, sf_dir):
    return parsed(spark, sf_dir).select("seq", "event_id", "event_type", "is_live", "event_epoch", "reject_reason")


@query("events_rejects", oracle("""
SELECT seq, received_epoch, 'application/json' AS content_type, reason AS failure_reason FROM heard WHERE reason IS NOT NULL""", "heard"))
def _(spark, sf_dir):
    return envelope.rejects(parsed(spark, sf_dir)).drop("raw_body", "received_at")


@query("events_dedup_first", oracle(
    "SELECT seq, eid AS event_id, etype AS event_type, received_epoch FROM logged", "logged"))
def _(spark, sf_dir):
    return events(spark, sf_dir).select("seq", "event_id", "event_type", "received_epoch")


_ROUTE = """CASE WHEN etype = 'url.validate' THEN 'ping' WHEN etype LIKE 'user.user%' THEN 'users'
 WHEN etype LIKE 'transaction.user_purchase_%' THEN 'transactions' WHEN etype LIKE 'session.session_%' THEN 'sessions'
 WHEN etype LIKE 'assessments.%' THEN 'assessments' WHEN etype LIKE 'course.%' THEN 'course_completion'
 WHEN etype LIKE 'announcement.%' THEN 'announcements' WHEN etype LIKE 'certificate.%' THEN 'certificates' ELSE 'none' END"""
_PROBLEM = """CASE WHEN route IN ('users', 'transactions', 'sessions') AND no_user THEN 'missing key'
 WHEN route = 'assessments' AND bad_mark THEN 'bad value' END"""
_JUDGED = {"routed": f"SELECT *, {_ROUTE} AS route FROM logged", "judged": f"SELECT *, {_PROBLEM} AS problem FROM routed"}


@query("events_route_counts", oracle("""
SELECT route, COUNT(*) AS total, COUNT(*) FILTER (WHERE problem IS NULL AND route <> 'ping') AS processed
FROM judged GROUP BY route""", "logged", **_JUDGED))
def _(spark, sf_dir):
    return routing.route_counts(events(spark, sf_dir))


@query("events_retry_queue", oracle("""
SELECT seq, eid AS event_id, etype AS event_type, route, problem FROM judged WHERE problem IS NOT NULL""", "logged", **_JUDGED))
def _(spark, sf_dir):
    return routing.retry_queue(events(spark, sf_dir))


_UPDATED = "etype = 'user.user_updated'"
_FIELDS = f"""
SELECT seq, CASE WHEN NOT no_user THEN u END AS user_id, CASE WHEN shape IN (0, 1, 2) THEN city END AS city,
 CASE WHEN shape = 2 THEN pin END AS pincode, CASE WHEN shape = 1 THEN parent END AS parent_name,
 CASE WHEN shape = 0 THEN '0123' END AS contact_number FROM logged WHERE {_UPDATED}"""


@query("events_field_lookup", oracle(_FIELDS, "logged"))
def _(spark, sf_dir):
    updated = events(spark, sf_dir).filter("event_type = 'user.user_updated'")
    return routing.entity_rows(updated, "users").select("seq", "user_id", "city", "pincode", "parent_name", "contact_number")


def _latest_sql(c: str, when: str = "TRUE") -> str:
    return f"list({c} ORDER BY seq DESC) FILTER (WHERE {when})[1]"


@query("users_upsert_created", oracle(f"""
SELECT u AS user_id, {_latest_sql('eid')} AS event_id, 'user.user_created' AS event_type,
 {_latest_sql('email', 'email IS NOT NULL')} AS email, {_latest_sql('person', 'person IS NOT NULL')} AS full_name,
 list(ep ORDER BY seq)[1] AS created_epoch, {_latest_sql('received_epoch')} AS received_epoch
FROM logged WHERE etype = 'user.user_created' AND NOT no_user GROUP BY u""", "logged"))
def _(spark, sf_dir):
    created = events(spark, sf_dir).filter("event_type = 'user.user_created'")
    return routing.fold_table(created, "users").select(
        "user_id", "event_id", "event_type", "email", "full_name", F.unix_seconds("created_at").alias("created_epoch"),
        F.unix_seconds("received_at").alias("received_epoch"))


@query("users_upsert_updated", oracle(f"""
SELECT user_id, {_latest_sql('eid')} AS event_id,
 COALESCE({_latest_sql('etype', 'is_new')}, list(etype ORDER BY seq)[1]) AS event_type,
 COALESCE({_latest_sql('email', 'is_new AND email IS NOT NULL')}, list(email ORDER BY seq)[1]) AS email,
 COALESCE({_latest_sql('person', 'is_new AND person IS NOT NULL')}, list(person ORDER BY seq)[1]) AS full_name,
 list(contact ORDER BY seq)[1] AS contact_number,
 {_latest_sql('town', 'town IS NOT NULL')} AS city, {_latest_sql('pincode', 'pincode IS NOT NULL')} AS pincode,
 {_latest_sql('parent_name', 'parent_name IS NOT NULL')} AS parent_name,
 list(made ORDER BY seq)[1] AS created_epoch, {_latest_sql('ep', 'NOT is_new')} AS updated_epoch,
 {_latest_sql('received_epoch')} AS received_epoch
FROM (SELECT *, u AS user_id, etype = 'user.user_created' AS is_new,
       CASE WHEN etype = 'user.user_created' THEN ep END AS made,
       CASE WHEN {_UPDATED} AND shape = 0 THEN '0123' END AS contact,
       CASE WHEN {_UPDATED} AND shape IN (0, 1, 2) THEN city END AS town,
       CASE WHEN {_UPDATED} AND shape = 2 THEN pin END AS pincode,
       CASE WHEN {_UPDATED} AND shape = 1 THEN parent END AS parent_name
      FROM logged WHERE etype LIKE 'user.user%' AND NOT no_user) changes
GROUP BY user_id""", "logged"))
def _(spark, sf_dir):
    return routing.fold_table(events(spark, sf_dir), "users").select(
        "user_id", "event_id", "event_type", "email", "full_name", "contact_number", "city", "pincode", "parent_name",
        F.unix_seconds("created_at").alias("created_epoch"), F.unix_seconds("updated_at").alias("updated_epoch"),
        F.unix_seconds("received_at").alias("received_epoch"))


@query("sessions_upsert", oracle(f"""
SELECT u AS attendance_id, {_latest_sql('eid')} AS event_id,
 {_latest_sql("CASE WHEN etype NOT LIKE '%cancel' THEN st END")} AS status, {_latest_sql('received_epoch')} AS received_epoch,
 list(etype ORDER BY seq)[1] AS event_type, list(m ORDER BY seq)[1] AS class_id,
 list('Class ' || CAST(st AS STRING) ORDER BY seq)[1] AS class_name, list(ep ORDER BY seq)[1] AS scheduled_epoch,
 list(CASE WHEN shape = 1 THEN ep + 60 END ORDER BY seq)[1] AS actual_epoch
FROM logged WHERE etype LIKE 'session.%' AND NOT no_user GROUP BY u""", "logged"))
def _(spark, sf_dir):
    return routing.fold_table(events(spark, sf_dir), "sessions").select(
        "attendance_id", "event_id", "status", F.unix_seconds("received_at").alias("received_epoch"), "event_type",
        "class_id", "class_name", F.unix_seconds("scheduled_start").alias("scheduled_epoch"),
        F.unix_seconds("actual_start").alias("actual_epoch"))


#: The tables keyed by event id see each id once per load; sent again, later copies meet the stored row.
_RESENT = {"sent": """SELECT *, row_number() OVER (PARTITION BY eid ORDER BY seq) AS sent_no FROM heard WHERE reason IS NULL"""}


def _all_copies(spark, sf_dir) -> DataFrame:
    return envelope.accepted(parsed(spark, sf_dir))


@query("assessments_upsert", oracle(f"""
SELECT eid AS event_id, {_latest_sql('CAST(v AS DECIMAL(8,2))')} AS mark, {_latest_sql('received_epoch')} AS received_epoch,
 list(etype ORDER BY seq)[1] AS event_type, list(u ORDER BY seq)[1] AS user_id, list(m ORDER BY seq)[1] AS attempt_id,
 CAST(list(st % 2 ORDER BY seq)[1] AS INT) AS is_evaluated,
 list(CASE WHEN shape = 0 THEN ep ELSE ep + 5 END ORDER BY seq)[1] AS submitted_epoch
FROM heard WHERE reason IS NULL AND etype LIKE 'assessments.%' AND NOT bad_mark GROUP BY eid""", "heard"))
def _(spark, sf_dir):
    return routing.fold_table(_all_copies(spark, sf_dir), "assessments").select(
        "event_id", "mark", F.unix_seconds("received_at").alias("received_epoch"), "event_type", "user_id", "attempt_id",
        "is_evaluated", F.unix_seconds("submitted_at").alias("submitted_epoch"))


def _first_sql(columns: str, kind: str) -> str:
    return oracle(f"SELECT eid AS event_id, etype AS event_type, {columns}, received_epoch FROM sent "
                  f"WHERE sent_no = 1 AND etype LIKE '{kind}.%'", "heard", **_RESENT)


@query("completions_first_wins", _first_sql(
    "u AS user_id, b AS bundle_id, CASE WHEN shape = 3 THEN ep ELSE ep + 7 END AS completed_epoch", "course"))
def _(spark, sf_dir):
    return routing.fold_table(_all_copies(spark, sf_dir), "course_completion").select(
        "event_id", "event_type", "user_id", "bundle_id", F.unix_seconds("completed_at").alias("completed_epoch"),
        F.unix_seconds("received_at").alias("received_epoch"))


@query("announcements_json", _first_sql(
    "CASE WHEN shape <> 3 THEN '{\"announcement_id\":' || CAST(e AS STRING) || '}' END AS raw_data", "announcement"))
def _(spark, sf_dir):
    return routing.fold_table(_all_copies(spark, sf_dir), "announcements").select(
        "event_id", "event_type", "raw_data", F.unix_seconds("received_at").alias("received_epoch"))


@query("certificates_first_wins", _first_sql(
    "'CERT-' || CAST(e AS STRING) AS certificate_id, u AS user_id, ep + 9 AS issued_epoch", "certificate"))
def _(spark, sf_dir):
    return routing.fold_table(_all_copies(spark, sf_dir), "certificates").select(
        "event_id", "event_type", "certificate_id", "user_id", F.unix_seconds("issued_at").alias("issued_epoch"),
        F.unix_seconds("received_at").alias("received_epoch"))


@query("events_latest_10", oracle("""
SELECT * FROM (SELECT 'event' AS kind, seq, received_epoch, etype AS detail FROM logged ORDER BY received_epoch DESC, seq LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'failure', seq, received_epoch, reason FROM heard WHERE reason IS NOT NULL ORDER BY received_epoch DESC, seq LIMIT 10)""",
                                  "logged"))
def _(spark, sf_dir):
    good = quality.latest(events(spark, sf_dir), "received_epoch", ["seq"])
    bad = quality.latest(envelope.rejects(parsed(spark, sf_dir)), "received_epoch", ["seq"])
    return good.select(F.lit("event").alias("kind"), "seq", "received_epoch", F.col("event_type").alias("detail")).unionByName(
        bad.select(F.lit("failure").alias("kind"), "seq", "received_epoch", F.col("failure_reason").alias("detail")))


@query("events_replay_fallback", oracle("""
SELECT 'recovered' AS outcome, COUNT(*) AS messages FROM logged WHERE seq > 1000000000 OR eid IS NOT NULL AND u % 2 = 1
UNION ALL SELECT 'remaining', COUNT(*) FROM heard WHERE reason IS NOT NULL""", "logged"))
def _(spark, sf_dir):
    # Every message went to the fallback file; the log knows those of even users.
    everything = messages(spark, sf_dir)
    path = session.scratch_path(spark, "fallback")
    everything.select("seq", F.lit("DB down").alias("reason"), "body", F.col("content_type").alias("type")).write.json(path)
    known = events(spark, sf_dir).filter("seq < 1000000000").join(
        fixture(spark, sf_dir, "messages").filter("u % 2 = 0").select("seq"), "seq", "left_semi")
    recovered, remaining = replay(spark, path, known)
    return recovered.agg(F.count("*").alias("messages")).select(F.lit("recovered").alias("outcome"), "messages").unionByName(
        remaining.agg(F.count("*").alias("messages")).select(F.lit("remaining").alias("outcome"), "messages"))


_TABLES = ("users", "transactions", "sessions", "assessments", "course_completion", "announcements", "certificates")


@query("events_stream_equals_batch", oracle("""
SELECT route AS table_name, CASE WHEN route = 'users' THEN COUNT(DISTINCT u) WHEN route = 'sessions' THEN COUNT(DISTINCT u)
 WHEN route = 'transactions' THEN COUNT(DISTINCT CASE WHEN etype NOT LIKE '%failed' THEN (u, b, m) END)
  + COUNT(*) FILTER (WHERE etype LIKE '%failed') ELSE COUNT(*) END AS row_count,
 CAST(0 AS BIGINT) AS only_in_stream, CAST(0 AS BIGINT) AS only_in_batch
FROM judged WHERE problem IS NULL AND route NOT IN ('ping', 'none') GROUP BY route""", "logged", **_JUDGED))
def _(spark, sf_dir):
    root = session.scratch_path(spark, "stream")
    landed = session.stored(messages(spark, sf_dir).select("seq", "received_at", "content_type", "body"), "messages")
    highest = landed.filter("seq < 1000000000").agg(F.max("seq")).first()[0]
    pipeline = EventPipeline(spark, f"{root}/out", buckets=4)
    # Messages land in two waves in arrival order; the second time the stream resumes from its checkpoint.
    for low, high in ((-1, highest // 2), (highest // 2, None)):
        wave = landed.filter(F.col("seq") > low)
        (wave if high is None else wave.filter(F.col("seq") <= high)).write.mode("append").json(f"{root}/landing")
        pipeline.start(read_messages(spark, f"{root}/landing"), f"{root}/checkpoint").awaitTermination()
    logged = dedup.first_seen(envelope.accepted(envelope.parse(landed)).withColumn("data", F.to_json("data")), ["event_id"], ["seq"])
    everything = session.stored(logged, "events").withColumn("data", F.parse_json("data"))
    parts = []
    for name in _TABLES:
        streamed = pipeline.table(name).read()
        batch = routing.fold_table(everything, name).select(streamed.columns)
        row = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in batch.columns]
        both = streamed.select(F.concat_ws("\1", *row).alias("row"), F.lit(1).alias("s"), F.lit(0).alias("b")).unionByName(
            batch.select(F.concat_ws("\1", *row).alias("row"), F.lit(0).alias("s"), F.lit(1).alias("b")))
        counted = both.groupBy("row").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
        parts.append(counted.agg(
            F.sum("s").alias("row_count"),
            F.sum(F.greatest(F.col("s") - F.col("b"), F.lit(0))).alias("only_in_stream"),
            F.sum(F.greatest(F.col("b") - F.col("s"), F.lit(0))).alias("only_in_batch"),
        ).select(F.lit(name).alias("table_name"), "row_count", "only_in_stream", "only_in_batch"))
    return reduce(DataFrame.unionByName, parts)
