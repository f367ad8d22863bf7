"""The event pipeline on literal messages."""

import json

import pytest
from pyspark.sql import functions as F

from tutorlake.operators import dedup, envelope
from tutorlake.plans import routing
from tutorlake.streaming.runner import EventPipeline, MESSAGE_SCHEMA, read_messages, replay
from tutorlake.streaming.tables import children

T0 = 1700000000


def flat(kind, number, data, **more):
    return {"id": f"{kind.split('.')[0]}-{number}", "event_name": kind, "event_timestamp": T0 + number, "is_live_mode": False,
            "data": data, **more}


#: One event of every documented kind, in arrival order.
EVENTS = [
    flat("transaction.user_purchase_initiated", 1, {
        "user_id": 501, "email": "ann@example.org", "full_name": "Ann", "bundle_id": 70, "course_name": "Logic", "master_batch_id": 9,
        "master_batch_name": "Evening", "original_price": 120.0, "discount": 20.0, "final_price": 100.0, "currency": "EUR"}),
    flat("transaction.user_purchase_failed", 2, {
        "user_id": 502, "email": "bob@example.org", "full_name": "Bob", "bundle_id": 70, "course_name": "Logic", "final_price": 100.0}),
    flat("session.session_created", 3, {
        "attendance_id": 88, "class_id": 31, "class_name": "Lesson 1", "class_type_formatted": "Live", "gmt_start_time": T0, "status": 0,
        "master_batches": [{"master_batch_id": 9}]}),
    flat("session.session_update", 4, {"attendance_id": 88, "class_id": 31, "class_name": "Lesson one", "gmt_start_time": T0 + 60}),
    flat("session.session_cancel", 5, {"attendance_id": 88, "cancellation_reason": "ill", "cancelled_by": 4}),
    flat("session.session_started", 6, {"attendance_id": 88, "actual_start_time": T0 + 90, "taken_at": T0 + 90, "status": 1}),
    flat("session.session_reminders", 7, {"attendance_id": 88, "reminder_type": "hour"}),
    flat("assessments.test_submitted", 8, {"user_id": 501, "attempt_id": 61, "mark": 0, "is_evaluated": 0, "submitted_at": T0 + 8}),
    flat("assessments.test_evaluated", 9, {"user_id": 501, "attempt_id": 61, "mark": 71.5, "is_evaluated": 1, "submitted_at": T0 + 8}),
    flat("assessments.exercise_submitted", 10, {"user_id": 501, "attempt_id": 62, "exercise_id": 5, "mark": 0, "is_evaluated": 0}),
    flat("assessments.exercise_evaluated", 11, {"user_id": 501, "attempt_id": 62, "exercise_id": 5, "mark": 90, "is_evaluated": 1}),
    flat("course.user_course_completed", 12, {"user_id": 501, "bundle_id": 70, "completed_at": T0 + 12}),
    flat("announcement.announcement_created", 13, {"announcement_id": 3, "title": "Hello"}),
    flat("certificate.certificate_issued", 14, {"certificate_id": "C-1", "user_id": 501, "issued_at": T0 + 14}),
]


def landed(spark, bodies):
    rows = [(i, body if isinstance(body, str) else json.dumps(body)) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "seq bigint, body string").select(
        "seq", F.timestamp_seconds(F.col("seq") + T0).alias("received_at"), F.lit("application/json").alias("content_type"), "body")


def accepted(spark, bodies):
    return envelope.accepted(envelope.parse(landed(spark, bodies)))


def test_each_kind_reaches_its_table(spark):
    events = accepted(spark, EVENTS)
    state = {name: routing.fold_table(events, name) for name in routing.FIELDS}
    assert {name: df.count() for name, df in state.items()} == {
        "users": 0, "transactions": 2, "sessions": 1, "assessments": 4, "course_completion": 1, "announcements": 1, "certificates": 1}
    session = state["sessions"].withColumn("start", F.unix_seconds("scheduled_start")).first()
    assert (session.event_id, session.event_type, session.class_name, session.start) == (
        "session-7", "session.session_created", "Lesson 1", T0)
    assert session.status is None and session.actual_start is None
    paid = state["transactions"].filter("user_id = 501").first()
    assert (str(paid.final_price), paid.source, paid.full_name) == ("100.00", "webhook", "Ann")


@pytest.mark.parametrize("body, event_id, reason", [
    ("{broken", None, "Not JSON"), ("null", None, "Not JSON"), ("[1]", None, "Not JSON"),
    ({"event_name": "a.b"}, None, "No ID"), ({"id": None, "event_name": "a.b"}, None, "No ID"),
    ({"id": "x1"}, "x1", "Bronze fail"), ({"id": 7, "event_name": "a.b"}, "7", None),
    ({"event": {"event": "a.b", "event_ts": "2024-03-08T04:30:00+00:00"}, "payload": {}}, "a.b-2024-03-08T04:30:00+00:00", None),
    ({"event": {"event": "a.b"}}, "a.b-", None), ({"event": {"event": "a.b", "event_ts": None}}, "a.b-None", None),
    ({"event": {"event": None, "event_ts": "t"}}, "None-t", "Bronze fail"),
    ({"event": {"event": "a.b"}, "id": None, "event_name": "c.d"}, None, "No ID")])
def test_envelopes(spark, body, event_id, reason):
    row = envelope.parse(landed(spark, [body])).first()
    assert (row.event_id, row.reject_reason) == (event_id, reason)


def test_live_flag_defaults_to_true_only_when_missing(spark):
    base = {"event_name": "a.b", "data": {}}
    bodies = [{"id": 1, **base}, {"id": 2, **base, "is_live_mode": False}, {"id": 3, **base, "is_live_mode": None}]
    assert [r.is_live for r in accepted(spark, bodies).orderBy("seq").collect()] == [True, False, None]


@pytest.mark.parametrize("kind, data, problem", [
    ("user.user_created", {"email": "x"}, "missing key"), ("user.user_created", None, "data is not an object"),
    ("user.user_updated", {"user": [1]}, "data is not an object"), ("user.user_updated", {"user": None, "id": 5}, None),
    ("transaction.user_purchase_completed", {"user_id": "abc"}, "bad value"), ("session.session_created", {}, "missing key"),
    ("assessments.quiz", {"mark": "high"}, "bad value"), ("announcement.announcement_created", None, None),
    ("announcement.announcement_created", [1, 2], None), ("manual.test", None, None), ("url.validate", {}, None)])
def test_problems(spark, kind, data, problem):
    queue = routing.retry_queue(accepted(spark, [{"id": "e", "event_name": kind, "data": data}]))
    assert [r.problem for r in queue.collect()] == ([problem] if problem else [])


def test_user_events_mix(spark):
    events = accepted(spark, [
        flat("user.user_updated", 1, {"user": {"id": 8, "email": "a@x", "phone": "1", "city": "Rome"}}),
        flat("user.user_created", 2, {"user_id": 8, "name": "Eve"}),
        flat("user.user_updated", 3, {"user_id": 8, "email": "late@x", "system_fields": [
            {"field_display_name": "Pin Code", "field_value": "00100"}, {"field_name": "parent_name", "field_value": "Pa"}]})])
    events = events.withColumn("event_id", F.concat("event_id", F.col("seq").cast("string")))
    user = routing.fold_table(events, "users").withColumn("updated", F.unix_seconds("updated_at")).first()
    assert (user.email, user.full_name, user.contact_number, user.city, user.pincode, user.parent_name) == (
        "a@x", "Eve", "1", "Rome", "00100", "Pa")
    assert (user.event_type, user.updated, user.created_at) == ("user.user_created", T0 + 3, None)


def state_of(pipeline, name):
    table = pipeline.table(name).read()
    return [] if table is None else sorted(map(repr, table.select(*sorted(table.columns)).collect()))


def test_repeated_micro_batch_changes_nothing(spark, tmp_path):
    first, second = landed(spark, EVENTS[:6]), landed(spark, EVENTS).filter("seq >= 4")
    pipeline = EventPipeline(spark, str(tmp_path), buckets=3)
    pipeline.process(first, 0)
    pipeline.process(second, 1)
    names = list(routing.FIELDS)
    once = {n: state_of(pipeline, n) for n in names}
    pipeline.process(second, 1)
    assert {n: state_of(pipeline, n) for n in names} == once
    whole = dedup.first_seen(accepted(spark, EVENTS).withColumn("data", F.to_json("data")), ["event_id"], ["seq"])
    for name in names:
        batch = routing.fold_table(whole.withColumn("data", F.parse_json("data")), name)
        assert sorted(map(repr, batch.select(*sorted(batch.columns)).collect())) == once[name]
        rebuilt = pipeline.rebuild(name)
        assert sorted(map(repr, rebuilt.select(*sorted(rebuilt.columns)).collect())) == once[name]


def test_old_versions_go_but_a_repeat_still_works(spark, tmp_path):
    pipeline = EventPipeline(spark, str(tmp_path), buckets=1, fan_in=2)
    waves = [landed(spark, EVENTS).filter(F.col("seq") == n) for n in range(2, 6)]
    for number, wave in enumerate(waves):
        pipeline.process(wave, number)
    table = pipeline.table("sessions")
    assert sorted(children(spark, table.path)) == ["version=1", "version=3"]
    assert sorted(children(spark, table.changes)) == ["versions=2-2", "versions=3-3"]
    once = state_of(pipeline, "sessions")
    pipeline.process(waves[-1], 3)
    assert state_of(pipeline, "sessions") == once


def test_stream_with_watermark_keeps_messages_without_id(spark, tmp_path):
    bodies = [EVENTS[0], EVENTS[0], "{broken", "{broken", {"event_name": "a.b"}]
    landed(spark, bodies).write.json(str(tmp_path / "in"))
    pipeline = EventPipeline(spark, str(tmp_path / "out"), buckets=2, watermark="1 hour")
    pipeline.start(read_messages(spark, str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()
    assert pipeline.table("transactions").read().count() == 1
    assert sorted(r.reason for r in pipeline.failed().collect()) == ["No ID", "Not JSON", "Not JSON"]


def test_replay(spark, tmp_path):
    lines = landed(spark, [EVENTS[0], EVENTS[1], EVENTS[1], "{broken"]).select("seq", F.lit("DB down").alias("reason"), "body")
    lines.write.json(str(tmp_path / "f"))
    known = accepted(spark, EVENTS[:1]).select("event_id")
    recovered, remaining = replay(spark, str(tmp_path / "f"), known)
    assert ([r.event_id for r in recovered.collect()], remaining.count()) == (["transaction-2"], 1)
    assert "seq" in MESSAGE_SCHEMA


def test_replay_merges_the_ids_of_the_log_instead_of_broadcasting_them(spark, tmp_path):
    bodies = [{"id": f"e{i}", "event_name": "a.b", "data": {}} for i in (1, 2, 2, 3, 3, 3)] + ["{broken", {"event_name": "a.b"}]
    landed(spark, bodies).select("seq", F.lit("DB down").alias("reason"), "body").write.json(str(tmp_path / "f"))
    landed(spark, [bodies[1], bodies[1], {"id": "e9", "event_name": "a.b"}]).write.parquet(str(tmp_path / "log"))
    # Ids read out of documents: their size is estimated by that of the file, less the documents.
    known = EventPipeline.parsed(spark.read.parquet(str(tmp_path / "log")))
    recovered, remaining = replay(spark, str(tmp_path / "f"), known)
    plan = recovered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    # Copies are dropped before the log is asked.
    assert plan.index("SortMergeJoin") < plan.index("min_by")
    assert sorted((r.event_id, r.seq) for r in recovered.collect()) == [("e1", 0), ("e3", 3)]
    assert remaining.count() == 2


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    EventPipeline(spark, str(tmp_path), buckets=2).process(landed(spark, EVENTS), 0)
    with pytest.raises(ValueError):
        EventPipeline(spark, str(tmp_path), buckets=3).table("sessions")


def test_event_tables_are_added_to_and_never_rewritten(spark, tmp_path):
    pipeline = EventPipeline(spark, str(tmp_path), buckets=2)
    for number, (low, high) in enumerate(((0, 10), (10, 100))):
        pipeline.process(landed(spark, EVENTS).filter((F.col("seq") >= low) & (F.col("seq") < high)), number)
    path = pipeline.table("certificates").path
    sizes = [sum(f.stat().st_size for f in tmp_path.joinpath("silver/certificates").joinpath(n).glob("*.parquet"))
             for n in children(spark, path)]
    assert pipeline.table("certificates").read().count() == 1 and len(sizes) >= 1
