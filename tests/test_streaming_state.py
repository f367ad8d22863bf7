"""What micro-batches read and write, and what repeats, crashes, folds and deletions leave."""

import random

import pytest
from pyspark.sql import functions as F
from test_events import EVENTS, T0, flat, landed, state_of

from tutorlake.operators import predicates, upsert
from tutorlake.operators.policies import TableRule, USERS
from tutorlake.plans import routing
from tutorlake.streaming import runner
from tutorlake.streaming.runner import EventPipeline, read_messages
from tutorlake.streaming.tables import EventTable, MergedTable, bytes_below, children, mark

RULE = TableRule(keys=("k",), policies={"a": upsert.FIRST, "b": upsert.LAST, "c": upsert.LAST_VALUE, "event_id": upsert.LAST})
SCHEMA = "seq long, k long, a string, b string, c string, event_id string"


def changes(rng, version, n):
    return [(version * 1000 + i, rng.choice([None, *range(9)]), f"a{version}.{i}", rng.choice([None, f"b{i}"]),
             rng.choice([None, f"c{version}"]), f"e{version}.{i}") for i in range(n)]


def rows_of(df):
    return [] if df is None else sorted(map(repr, df.select("k", "a", "b", "c", "event_id").collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("fan_in, share", [(2, 0.0), (2, 50.0), (3, 0.5), (100, 0.5)])
def test_merged_table_equals_one_fold(spark, tmp_path, fan_in, share):
    rng, told = random.Random(fan_in), []
    table = MergedTable(spark, str(tmp_path / "t"), RULE, 3, fan_in, share)
    for version in range(7):
        batch = changes(rng, version, rng.randrange(0, 6))
        table.append(frame(spark, batch), version)
        if version in (3, 6):  # the micro-batch runs again
            table.append(frame(spark, batch), version)
        told += batch
    assert rows_of(table.read()) == rows_of(upsert.fold(frame(spark, told), RULE.keys, ["seq"], RULE.policies))


def test_folders_of_changes_stay_few(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), RULE, 2, fan_in=2, share=1e9)
    table.append(frame(spark, changes(random.Random(0), 0, 5)), 0)
    table.append(frame(spark, changes(random.Random(1), 1, 5)), 1)  # nothing is stored yet, so this folds
    for version in range(2, 18):
        table.append(frame(spark, changes(random.Random(version), version, 1)), version)
    after, spans = table._state()
    assert after == 1 and len(spans) <= 5 and (spans[0][0], spans[-1][1]) == (2, 17)


@pytest.mark.parametrize("fan_in", [2, 3, 100])
def test_deleted_rows_stay_away_and_later_changes_count(spark, tmp_path, fan_in):
    rng = random.Random(7)
    batches = [changes(rng, v, 8) for v in range(3)]
    table = MergedTable(spark, str(tmp_path / "t"), RULE, 2, fan_in)
    for version in (0, 1):
        table.append(frame(spark, batches[version]), version)
    before = table.read().collect()
    table.delete(F.col("k") < 5)
    # Rows without a key go by themselves, not with all others that have none.
    one = next(r.event_id for r in before if r.k is None)
    table.delete(F.col("event_id") == one)
    kept = sorted(repr(r) for r in before if (r.k is None or r.k >= 5) and r.event_id != one)
    assert sorted(map(repr, table.read().collect())) == kept
    table.append(frame(spark, batches[1]), 1)
    assert sorted(map(repr, table.read().collect())) == kept
    table.append(frame(spark, batches[2]), 2)
    table.fold(2)
    survivors = [r for r in batches[0] + batches[1] if (r[1] is None or r[1] >= 5) and r[5] != one]
    expected = rows_of(upsert.fold(frame(spark, survivors + batches[2]), RULE.keys, ["seq"], RULE.policies))
    assert rows_of(table.read()) == expected
    assert rows_of(MergedTable(spark, str(tmp_path / "t"), RULE, 2, fan_in).read()) == expected


def test_a_bucket_that_loses_all_rows_is_empty_after_the_fold(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), RULE, 1, fan_in=2)
    table.append(frame(spark, [(0, 1, "a", "b", "c", "e")]), 0)
    table.delete(F.lit(True))
    table.append(frame(spark, []), 1)
    assert rows_of(table.read()) == []
    table.append(frame(spark, [(2, 1, "new", "b", "c", "e2")]), 2)
    assert [r.a for r in table.read().collect()] == ["new"]


def test_a_fold_that_did_not_finish_is_not_read(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), RULE, 2, fan_in=2)
    batches = [changes(random.Random(v), v, 5) for v in range(3)]
    for version, batch in enumerate(batches):
        table.append(frame(spark, batch), version)
    whole = rows_of(table.read())
    frame(spark, []).write.parquet(str(tmp_path / "t/version=9/bucket=0"))  # no mark of success above the buckets
    assert rows_of(table.read()) == whole


def test_bytes_written_follow_the_batch_not_the_table(spark, tmp_path):
    written = []
    for rows in (10, 20000):
        pipeline = EventPipeline(spark, str(tmp_path / str(rows)), buckets=2, fan_in=2)
        users = spark.range(rows).select(
            F.col("id").alias("seq"), F.timestamp_seconds(F.lit(T0)).alias("received_at"), F.lit("application/json").alias("content_type"),
            F.format_string('{"id":"e%d","event_name":"user.user_created","event_timestamp":1700000000,"data":{"user_id":%d,"email":"m%d@x"}}',
                            F.col("id"), F.col("id"), F.col("id")).alias("body"))
        pipeline.process(users.filter("seq = 0"), 0)
        pipeline.process(users.filter("seq > 0"), 1)  # folded
        assert pipeline.table("users").base.finished_version() == 1
        silver = str(tmp_path / str(rows) / "silver")
        before = bytes_below(spark, silver)
        pipeline.process(landed(spark, [flat("user.user_created", n, {"user_id": n}) for n in range(5)]).withColumn("seq", F.col("seq") + 10**6), 2)
        written.append(bytes_below(spark, silver) - before)
    assert written[1] <= 1.1 * written[0]


def _stream(spark, tmp_path, pipeline, files=None):
    query = pipeline.start(read_messages(spark, str(tmp_path / "in"), files), str(tmp_path / "cp"))
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_a_micro_batch_asks_the_state_for_its_own_ids_only(spark, tmp_path, monkeypatch):
    pipeline = EventPipeline(spark, str(tmp_path / "out"), buckets=2)

    def event(n):
        return flat("certificate.certificate_issued", n, {"certificate_id": f"C{n}", "user_id": 1})

    fixed = [event(n) for n in range(10)]
    landed(spark, fixed).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    asked = []
    for size in (50, 2000):
        _stream(spark, tmp_path, pipeline)
        wave = landed(spark, [event(10**6 * size + n) for n in range(size)]).withColumn("seq", F.col("seq") + 1000 * size)
        wave.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        _stream(spark, tmp_path, pipeline)
        # The log is not there for the micro-batch that follows.
        monkeypatch.setattr(EventTable, "read", lambda *a, **k: pytest.fail("the log was read"))
        again = fixed + [event(10**9 * size + n) for n in range(10)]
        landed(spark, again).withColumn("seq", F.col("seq") + 10**7 * size).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        (progress,) = _stream(spark, tmp_path, pipeline)
        asked.append(progress["stateOperators"][0]["customMetrics"]["rocksdbGetCount"])
        monkeypatch.undo()
    assert asked[0] == asked[1]
    assert pipeline.log.read().count() == 10 + 50 + 2000 + 20
    assert pipeline.log.read().filter("seq < 10").count() == 10


def test_the_stream_keeps_the_first_copy_of_a_micro_batch(spark, tmp_path):
    bodies = [EVENTS[0], "{broken", EVENTS[0], "{broken", {"id": "x1"}, EVENTS[0], {"id": "x1"}]
    landed(spark, bodies).withColumn("seq", 100 - F.col("seq")).repartition(5).write.json(str(tmp_path / "in"))
    pipeline = EventPipeline(spark, str(tmp_path / "out"), buckets=2)
    _stream(spark, tmp_path, pipeline)
    assert [(r.event_id, r.seq) for r in pipeline.log.read().collect()] == [("transaction-1", 95)]
    assert sorted(r.reason for r in pipeline.failed().collect()) == ["Bronze fail", "Bronze fail", "Not JSON", "Not JSON"]


def test_a_new_checkpoint_over_old_events_is_refused(spark, tmp_path):
    pipeline = EventPipeline(spark, str(tmp_path / "out"), buckets=2)
    pipeline.process(landed(spark, EVENTS), 0)
    landed(spark, EVENTS).write.json(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        pipeline.start(read_messages(spark, str(tmp_path / "in")), str(tmp_path / "cp"))


def _bad(n):
    return flat("certificate.certificate_issued", n, {"certificate_id": f"C{n}", "user_id": "nobody"})


def test_an_empty_micro_batch_does_not_rewrite_the_queue(spark, tmp_path):
    written = []
    for size in (3, 3000):
        root = tmp_path / str(size)
        pipeline = EventPipeline(spark, str(root), buckets=2)
        pipeline.process(landed(spark, [_bad(n) for n in range(size)]), 0)
        before = bytes_below(spark, str(root))
        pipeline.process(landed(spark, EVENTS[:1]).limit(0), 1)
        written.append(bytes_below(spark, str(root)) - before)
        assert pipeline.retry().count() == size
    assert written[0] == written[1]


def test_mended_events_are_tried_once_by_one_micro_batch(spark, tmp_path):
    pipeline = EventPipeline(spark, str(tmp_path), buckets=2)
    pipeline.process(landed(spark, [_bad(n) for n in range(4)]), 0)
    mended = pipeline.retry().withColumn("data", F.when(F.col("seq") == 1, F.col("data")).otherwise(F.lit('{"certificate_id":"ok","user_id":1}')))
    pipeline.mend(mended.filter("seq < 3"))
    pipeline.process(landed(spark, EVENTS[-1:]).withColumn("seq", F.lit(50).cast("long")), 1)
    expected = (["certificate-0", "certificate-14", "certificate-2"], ["certificate-1", "certificate-3"])

    def now():
        return (sorted(r.event_id for r in pipeline.table("certificates").read().collect()), sorted(r.event_id for r in pipeline.retry().collect()))

    assert now() == expected
    pipeline.process(landed(spark, EVENTS[-1:]).withColumn("seq", F.lit(50).cast("long")), 1)
    assert now() == expected
    pipeline.mend()
    pipeline.mend(mended.filter("seq = 3"))
    pipeline.process(landed(spark, EVENTS[:1]).limit(0), 2)
    assert now() == ([*expected[0][:2], "certificate-2", "certificate-3"], ["certificate-1"])
    # A rebuild takes mended events as they were handed in.
    assert sorted(r.event_id for r in pipeline.rebuild("certificates").collect()) == now()[0]


def test_a_rebuild_takes_the_place_of_the_old_table_in_one_step(spark, tmp_path, monkeypatch):
    pipeline = EventPipeline(spark, str(tmp_path), buckets=2, fan_in=2)
    pipeline.process(landed(spark, EVENTS).filter("seq < 4"), 0)
    pipeline.process(landed(spark, EVENTS).filter("seq >= 4"), 1)
    right = {n: state_of(pipeline, n) for n in ("sessions", "certificates")}
    for name in right:  # the live tables lose something
        pipeline.table(name).delete(F.lit(True))
        assert state_of(pipeline, name) == []
        with monkeypatch.context() as crash:
            crash.setattr(runner, "mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                pipeline.rebuild_in_place(name)
        assert state_of(pipeline, name) == []
        pipeline.rebuild_in_place(name)
        assert state_of(pipeline, name) == right[name]
    more = [flat("session.session_cancel", 30, {"attendance_id": 88, "status": 9}), flat("certificate.certificate_issued", 31, {"certificate_id": "C-2", "user_id": 2})]
    pipeline.process(landed(spark, more).withColumn("seq", F.col("seq") + 100), 2)
    assert pipeline.table("sessions").path.endswith("sessions.1") and len(state_of(pipeline, "certificates")) == 2
    assert pipeline.table("sessions").read().first().event_id == "session-30"
    assert state_of(pipeline, "sessions") == sorted(map(repr, (lambda d: d.select(*sorted(d.columns)).collect())(pipeline.rebuild("sessions"))))


def test_cleaning_holds_against_repeats_and_rebuilds(spark, tmp_path):
    events = [flat("user.user_created", n, {"user_id": n if n % 2 else 99990000 + n, "email": f"m{n}@x"}, id=f"{'e2e' if n % 3 == 0 else 'ev'}-{n}")
              for n in range(12)]
    pipeline = EventPipeline(spark, str(tmp_path), buckets=2, fan_in=2)
    pipeline.process(landed(spark, events[:6]), 0)
    second = landed(spark, events).filter("seq >= 6")
    pipeline.process(second, 1)
    pipeline.clean({"webhook_events": predicates.test_event(F.col("event_id")), "users": predicates.test_user(F.col("email"), F.col("user_id"))})
    pipeline.process(second, 1)
    assert sorted(r.user_id for r in pipeline.table("users").read().collect()) == [1, 3, 5, 7, 9, 11]
    assert pipeline.log.read().count() == 8
    pipeline.rebuild_in_place("users")
    assert sorted(r.user_id for r in pipeline.table("users").read().collect()) == [1, 5, 7, 11, 99990002, 99990004, 99990008, 99990010]


def test_user_changes_of_many_micro_batches_mix_as_in_one_fold(spark, tmp_path):
    rng, events = random.Random(3), []
    for n in range(40):
        user = rng.randrange(4)
        if rng.random() < 0.5:
            events.append(flat("user.user_created", n, {"user_id": user, "email": f"m{n}@x", "name": f"N{n}"}))
        else:
            events.append(flat("user.user_updated", n, {"user": {"id": user, "email": f"u{n}@x", "city": rng.choice(["Rome", "Oslo"])}}))
    events = [{**e, "id": f"u{n}"} for n, e in enumerate(events)]
    pipeline = EventPipeline(spark, str(tmp_path), buckets=3, fan_in=3)
    for batch in range(8):
        pipeline.process(landed(spark, events).filter(F.col("seq").between(batch * 5, batch * 5 + 4)), batch)
    whole = routing.fold_table(pipeline.events(), "users")
    assert state_of(pipeline, "users") == sorted(map(repr, whole.select(*sorted(whole.columns)).collect()))
    assert set(whole.columns) == {*USERS.keys, *USERS.policies}
    assert children(spark, f"{tmp_path}/silver/users.buckets") == ["3"] and mark is not None


def test_the_state_is_asked_without_a_python_call_per_key(spark, tmp_path):
    bodies = [flat("certificate.certificate_issued", n % 40, {"certificate_id": f"C{n}", "user_id": 1}) for n in range(80)]
    landed(spark, bodies).write.json(str(tmp_path / "in"))
    pipeline = EventPipeline(spark, str(tmp_path / "out"), buckets=2)
    (progress,) = _stream(spark, tmp_path, pipeline)
    (state,) = progress["stateOperators"]
    assert (state["operatorName"], state["numRowsTotal"]) == ("dedupe", 40)
    assert sorted(r.seq for r in pipeline.log.read().collect()) == list(range(40))
