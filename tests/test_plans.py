"""Skewed input against brute force, and the shape of physical plans."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import fixture
from tutorlake.operators.ranking import latest_flag, number_by_day
from tutorlake.plans import attendance, gold
from tutorlake.sources import calendar, csvfiles, pages, sinks

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def classes(spark):
    """Class records of which one batch holds a third."""
    chance = random.Random(7)
    rows = []
    for number in range(600):
        batch = 1 if number % 3 == 0 else chance.randrange(2, 40)
        day = None if number % 50 == 0 else date(2024, 1, 1) + timedelta(days=chance.randrange(20))
        rows.append((batch, number, batch * 10, day, chance.choice([None, 3, 4, 9]), chance.randrange(0, 10000) / 100))
    return rows, spark.createDataFrame(
        rows, "batch_id long, class_id long, bundle_id long, class_date date, present_count int, pct double").withColumn(
            "attendance_pct", F.col("pct").cast("decimal(5,2)"))


def numbers_of(rows):
    result = {}
    for batch in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == batch), key=lambda r: (r[3] is None, r[3], r[1]))
        result |= {r[1]: place for place, r in enumerate(mine, 1)}
    return result


def test_numbering_of_a_hot_batch(classes):
    rows, frame = classes
    numbered = number_by_day(frame, "batch_id", "class_date", "class_id", "class_number")
    assert {r.class_id: r.class_number for r in numbered.collect()} == numbers_of(rows)


def test_undated_classes_of_one_batch_spread_over_tasks(spark):
    """A third of all classes are undated classes of one batch: no task may hold them all, and no window ranks rows."""
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 100 = 1 THEN NULL ELSE 2 + id % 37 END AS batch_id", "id AS class_id",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) END AS class_date")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be joined
    try:
        numbered = number_by_day(rows, "batch_id", "class_date", "class_id", "class_number")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = {r.class_id: r.class_number for r in numbered.filter("batch_id = 1").collect()}
    assert hot == {3 * i: i + 1 for i in range(10_000)}
    assert numbered.filter("batch_id IS NULL AND class_number IS NOT NULL").count() == 0
    assert numbered.count() == 30_000
    assert "row_number" not in plan_of(numbered)
    ranges = spark.read.parquet(*numbered.inputFiles()).filter("batch_id = 1").groupBy(F.shiftright("__at", 33))
    held = [r["count"] for r in ranges.count().collect()]
    assert len(held) > 1 and max(held) < 10_000


def test_first_and_last_class_of_a_hot_batch(spark, classes):
    rows, frame = classes
    numbered = number_by_day(frame, "batch_id", "class_date", "class_id", "class_number")
    catalogue = spark.createDataFrame([(10, "Hot")], "bundle_id long, course_name string")
    batches = spark.createDataFrame(
        [(1, "B", "T", None, None, 50), (1, "B", "T", None, None, 50)],
        "batch_id long, batch_name string, tutor_name string, start_date date, end_date date, admitted_students int")
    hot = gold.batch_attendance(numbered, catalogue, batches).filter("batch_id = 1").collect()
    place = numbers_of(rows)
    mine = sorted((r for r in rows if r[0] == 1), key=lambda r: place[r[1]])
    assert len(hot) == 1
    assert (hot[0].first_class_present_count, hot[0].last_class_present_count) == (mine[0][4], mine[-1][4])
    assert (hot[0].total_classes_held, hot[0].total_class_count, hot[0].course_name) == (2 * len(mine), len(mine), "Hot")


def test_latest_flag_marks_one_row_per_group(spark):
    rows = [(g, i, None if i % 4 == 0 else date(2024, 1, 1 + i % 5)) for i in range(200) for g in [None if i % 3 == 0 else i % 7]]
    frame = spark.createDataFrame(rows, "g int, id int, d date")
    flagged = latest_flag(frame, "g", ["d", "id"], "latest").collect()
    for group in {r[0] for r in rows}:
        best = max((r for r in rows if r[0] == group), key=lambda r: (r[2] is not None, r[2] or date.min, r[1]))
        assert [r.id for r in flagged if r.g == group and r.latest] == [best[1]]


def test_plans_stay_on_the_jvm_without_cross_joins(spark):
    for name, build in registry.QUERIES.items():
        if name in ("csv_students_scan", "events_stream_equals_batch"):  # these write their input with Python
            continue
        plan = plan_of(build(spark, SF_DIR))
        for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert unwanted not in plan, (name, unwanted)


def test_pull_date_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    fixture(spark, SF_DIR, "attendance").write.partitionBy("pull_date").parquet(path)
    stored = spark.read.parquet(path).filter(F.col("pull_date") == F.lit("1998-06-01").cast("date"))
    plan = plan_of(attendance.summarise(stored))
    assert "PartitionFilters: [isnotnull(pull_date" in plan
    assert "IsNotNull(batch_id)" in plan and "In(attendance_status, [A,L,P])" in plan
    assert "student_comments" not in plan.split("ReadSchema")[1]


def test_users_are_counted_without_sets_or_expansion(spark):
    view = gold.course(*[fixture(spark, SF_DIR, n) for n in ("catalogue", "lifecycle", "transactions")])
    assert "Expand" not in plan_of(view)


def test_missing_file_has_no_students(spark, tmp_path):
    assert csvfiles.read_students_if_present(spark, str(tmp_path / "none.csv")).count() == 0


def test_student_file_with_line_before_header(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('Export of today\nName,#,Email,Age \n"A, ""x""\nB",1,,30\n,2,b@x,\n', encoding="utf-8")
    rows = csvfiles.read_students(spark, str(path)).orderBy("source_row").collect()
    assert [(r.source_row, r.name, r.row_number, r.email, r.age_v2) for r in rows] == [
        (0, 'A, "x"\nB', "1", None, "30"), (1, None, "2", "b@x", None)]


def test_split_files_are_numbered_in_file_order(spark, tmp_path):
    """A file read in many splits, with other files around it."""
    for part, (low, high) in enumerate([(0, 3), (3, 5000), (5000, 5100)]):
        (tmp_path / f"part-{part}.csv").write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(low, high)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = csvfiles.read_csv_dynamic(spark, str(tmp_path), multi_line=False)
        assert read.filter("source_row <> cast(a AS bigint)").count() == 0 and read.count() == 5100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_whole_file_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{\n "courses": [{"bundle_id": 1, "bundle_name": "X", "batch": "[{\\"class_id\\": 5}]"}]\n}')
    (tmp_path / "p2.json").write_text('[{"bundle_id": 2, "batch": [{"class_id": 6}, {"class_id": 7}]}, {"bundle_id": 3, "batch": "oops"}]')
    flat = pages.number_rows(pages.flatten_batches(pages.read_pages(spark, str(tmp_path)), "page"))
    found = flat.select("source_row", "bundle_id", F.to_json("batch").alias("b")).orderBy("source_row").collect()
    assert [tuple(r) for r in found] == [(0, "1", '{"class_id":5}'), (1, "2", '{"class_id":6}'), (2, "2", '{"class_id":7}')]


def test_summary_file(spark, tmp_path):
    summary = attendance.research_summary(
        fixture(spark, SF_DIR, "attendance").withColumn("seq", F.struct("k_order", "k_line", "k_part")))
    sinks.write_summary_csv(attendance.summary_export(summary, F.lit("2024-01-02 03:04:05")), str(tmp_path / "s"))
    back = spark.read.csv(str(tmp_path / "s"), header=True)
    assert back.count() == summary.count()
    assert back.columns[5:11] == ["class_date", "present_count", "late_count", "absent_count", "total_records", "attendance_pct"]


def test_calendar(spark):
    today = date(2024, 3, 10)
    assert calendar.target_range(today) == (date(2024, 3, 9), date(2024, 3, 9))
    assert calendar.target_range(today, start=date(2024, 3, 7)) == (date(2024, 3, 7), date(2024, 3, 9))
    assert calendar.target_range(today, day=date(2024, 1, 1)) == (date(2024, 1, 1), date(2024, 1, 1))
    days = calendar.calendar(spark, date(2024, 3, 7), date(2024, 3, 9)).orderBy("pull_date").collect()
    assert [d.pull_date.day for d in days] == [7, 8, 9]
    assert days[0].start_epoch == 1709749800 and days[0].end_epoch == 1709749800 + 86399
    assert calendar.calendar(spark, date(2024, 3, 9), date(2024, 3, 7)).count() == 0


def test_views_can_be_asked_in_sql(spark):
    tables = {
        "course_catalogue": fixture(spark, SF_DIR, "catalogue"), "course_lifecycle": fixture(spark, SF_DIR, "lifecycle"),
        "transactions": fixture(spark, SF_DIR, "transactions"), "course_batches": fixture(spark, SF_DIR, "batches"),
        "class_attendance": attendance.number_classes(attendance.summarise(fixture(spark, SF_DIR, "attendance"), by_pull=False))}
    names = gold.register_views(spark, tables)
    assert len(names) == 13
    assert spark.sql("SELECT sum(total_learners_count) AS n FROM gold_learner").first().n > 0


def test_landed_rows_read_their_fields_in_one_go(spark):
    """Odd values of alternate names, and the number of look-ups in a row."""
    entries = ['{"student_Id":"0","student_id":5,"studentRating":"4"}', '{"student_Id":0,"student_id":5}', '{"student_Id":"","student_id":" 7 "}',
               '{"student_Id":false,"student_id":null}', '{"student_Id":"false"}', '{"student_Id":-0.0,"student_id":"x"}', '{"student_id":9}',
               '{"student_Id":12,"classDate":"3 Mar 2024"}', '[1]', '{"student_Id":{"a":1},"student_id":3}', 'null']
    docs = spark.createDataFrame([(i, e) for i, e in enumerate(entries)], "seq int, e string").select(
        "seq", F.lit(None).cast("date").alias("pull_date"), F.parse_json("e").alias("row"))
    landed = attendance.landed_rows(docs)
    assert [r.student_id for r in landed.orderBy("seq").collect()] == [0, 5, 7, None, None, None, 9, 12, None, None, None]
    assert [str(r.class_date_parsed) for r in landed.filter("seq = 7").collect()] == ["2024-03-03"]
    ids = landed.select("student_id", "batch_id", "student_email", "class_date_parsed")._jdf.queryExecution().optimizedPlan().toString()
    assert "__texts" in ids and "studentEmail]" in ids and 'studentEmail"]' not in ids


def test_the_list_of_a_page_is_the_first_key_that_holds_something(spark):
    docs = ['{"data":[1,2],"rows":[3]}', '{"data":null,"rows":[3]}', '{"data":5,"rows":[3]}', '{"data":{"a":1},"rows":[3]}', '{"data":"","rows":[3]}',
            '{"report":[4]}', '{"data":[],"rows":[3]}', '[5]', '7', '{"data":false,"report":[4]}']
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "n int, d string").select("n", F.parse_json("d").alias("doc"))
    found = pages.unwrap_rows(rows, "n").select("n", "pos", F.to_json("row").alias("row"))
    assert sorted(map(tuple, found.collect())) == [(0, 0, "1"), (0, 1, "2"), (1, 0, "3"), (5, 0, "4")]
