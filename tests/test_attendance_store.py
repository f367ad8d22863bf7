"""Pulls into stored attendance tables."""

import datetime
import random

from pyspark.sql import functions as F

from tutorlake.operators.policies import ATTENDANCE_RAW
from tutorlake.plans import attendance, attendance_store
from tutorlake.plans.attendance_store import AttendanceStore
from tutorlake.streaming.tables import DatedTable

_NAMES = ("student_id class_id batch_id batch_name bundle_id bundle_name class_date_parsed attendance_id teacher_id teacher_name class_duration "
          "attendance_status student_email").split()
SCHEMA = ("pull_date date, seq long, student_id long, class_id long, batch_id long, batch_name string, bundle_id long, bundle_name string, "
          "class_date_parsed date, attendance_id long, teacher_id long, teacher_name string, class_duration string, attendance_status string, "
          "student_email string, is_staff boolean")


def day(n):
    return None if n is None else datetime.date(2024, 1, 1) + datetime.timedelta(n)


def pull(rng, n, size, students=12):
    return [(day(n), i, rng.choice([None, *range(students)]), c := rng.randrange(6), c % 3, f"b{c % 3}", 1, "u", day(c), 7, 8, "t", "60",
             rng.choice(["P", "A", "L", "x"]), "s@x", rng.random() < 0.1) for i in range(size)]


def stamp(n):
    return F.timestamp_seconds(F.lit(n))


def rows_of(df, names):
    return [] if df is None else sorted(map(repr, df.select(*names).collect()))


def test_loads_equal_the_whole_table_form(spark, tmp_path):
    rng, fan_in, days = random.Random(2), 2, 1
    store, bronze, classes = AttendanceStore(spark, str(tmp_path), 3, fan_in, days), None, None
    for number, dates in enumerate([(0, 1), (1,), (None, 3), (2,)]):
        frame = spark.createDataFrame([r for d in dates for r in pull(rng, d, 15)], SCHEMA)
        for _ in range(2 if number == 2 else 1):  # some loads run again
            store.load(frame, stamp(number), number)
        done = attendance.load_pull(frame, stamp(number), bronze, classes)
        bronze, classes = done.bronze, attendance.stored(done.classes, "test-classes")
        names = [*ATTENDANCE_RAW.keys, *(c for c in bronze.columns if c in _NAMES or c in ("pull_date", "loaded_at"))]
        assert rows_of(store.bronze.read(), names) == rows_of(bronze, names)
        assert rows_of(store.classes.read(), sorted(classes.columns)) == rows_of(classes, sorted(classes.columns))


def _files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_files_of_untouched_dates_and_batches_stay(spark, tmp_path):
    store = AttendanceStore(spark, str(tmp_path), 64)

    def rows(date, students, batch):
        return spark.createDataFrame([(day(date), s, s, 100 + batch, batch, "b", 1, "u", day(date), 7, 8, "t", "60", "P", "s@x", False) for s in students], SCHEMA)

    for number in range(5):
        store.load(rows(number, range(number * 10, number * 10 + 10), number), stamp(number), number)
    before = {name: _files(tmp_path / name) for name in ("bronze/attendance_raw", "silver/class_attendance")}
    # One student of the second date is pulled again with the last: two dates are written, three are not.
    store.load(rows(4, [10], 1).unionByName(rows(4, [40], 4)), stamp(9), 5)
    after = {name: _files(tmp_path / name) for name in before}
    kept = {name: {p for p in before[name] if after[name].get(p) == before[name][p]} for name in before}
    assert len(kept["bronze/attendance_raw"]) >= 3 and len(kept["silver/class_attendance"]) >= 3
    new = {p.split("bucket=")[1].split("/")[0] for p in set(after["bronze/attendance_raw"]) - set(before["bronze/attendance_raw"])}
    base = (day(0) - datetime.date(1970, 1, 1)).days
    assert new <= {str(base + 1), str(base + 4)}
    assert store.bronze.read().count() == 50


def test_a_date_that_loses_all_its_rows_is_empty(spark, tmp_path):
    store = AttendanceStore(spark, str(tmp_path), 2)
    for number, date in enumerate((0, 1)):
        row = (day(date), 1, 5, 100, 1, "b", 1, "u", day(date), 7, 8, "t", "60", "P", "s@x", False)
        store.load(spark.createDataFrame([row], SCHEMA), stamp(number), number)
    assert [(r.student_id, r.pull_date) for r in store.bronze.read().collect()] == [(5, day(1))]


def test_a_pull_is_stored_with_the_columns_that_are_read(spark, tmp_path, monkeypatch):
    kept, write = {}, attendance_store.stored
    monkeypatch.setattr(attendance_store, "stored", lambda df, label: kept.setdefault(label, write(df, label)))
    rows = spark.createDataFrame(pull(random.Random(4), 0, 40), SCHEMA).withColumn("k_order", F.col("seq"))
    store = AttendanceStore(spark, str(tmp_path), 2)
    store.load(rows, stamp(0), 0)
    assert set(kept["pull"].columns) == {*_NAMES, "pull_date", "seq", "loaded_at"}
    met = {(r.student_id, r.class_id) for r in kept["pull-met"].collect()}
    twice = rows.filter("NOT is_staff").groupBy("student_id", "class_id").count().filter("count > 1").collect()
    assert met == {(r.student_id, r.class_id) for r in twice}


def test_few_stretches_of_dates_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([r for n in range(6) for r in pull(random.Random(n), n, 20)], SCHEMA).drop("is_staff")
    side, dealt = (DatedTable(spark, f"{tmp_path}/{name}", "pull_date") for name in ("side", "dealt"))
    dealt.SIDE_BY_SIDE = 5
    kept, seen = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"), []
    for table in (side, dealt):
        table.laid_out = lambda df, own=table.laid_out: seen.append(own) or own(df)
        table.write_some(rows, 0, [], 6)
        assert rows_of(table.read(), rows.columns) == rows_of(rows, rows.columns)
    assert len(seen) == 1 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == kept
