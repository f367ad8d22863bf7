"""Work is dealt into tasks by the size of the tables, never into a fixed few."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrameWriter, functions as F

from checks import entities, faults, fixtures, reports, sources
from checks.common import QUERIES
from checks.messages import messages
from tutorlake.streaming.runner import EventPipeline
from tutorlake.streaming.tables import StateTable, children

CUSTOMERS = {"c_custkey": list(range(1, 41)), "c_nationkey": [0] * 40, "c_name": ["Ann"] * 40, "c_mktsegment": ["BUILDING"] * 40}


def _tables(spark, path):
    spark.createDataFrame([(i, i % 9) for i in range(40)], "o_orderkey long, o_custkey long").withColumn(
        "o_orderdate", F.lit("1996-01-02").cast("timestamp_ntz")).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(
        [(i % 40, i, i % 7, i % 7 + 1, 10.0, 5.0, "N", "O") for i in range(80)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double, l_quantity double, "
        "l_returnflag string, l_linestatus string").withColumn(
        "l_shipdate", F.lit("1996-03-04").cast("timestamp_ntz")).write.parquet(f"{path}/lineitem.parquet")
    pq.write_table(pa.table(CUSTOMERS), f"{path}/customer.parquet")
    return str(path)


def test_tasks_follow_the_size_of_the_table(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    assert fixtures.shares(spark, sf_dir, "lineitem", 1 << 30) == 4
    assert fixtures.shares(spark, sf_dir, "lineitem", 100) > 20


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), ["k"], 1)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        table.write(spark.range(0, 20000, 1, 8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")), 0)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert len([n for n in children(spark, f"{table.path}/version=0/bucket=0") if n.endswith(".parquet")]) > 1
    assert table.read().count() == 20000


def test_cleanup_spreads_a_table_of_one_row_group(spark, tmp_path, monkeypatch):
    sf_dir, seen, process = _tables(spark, tmp_path), [], EventPipeline.process
    monkeypatch.setattr(EventPipeline, "process", lambda self, rows, batch: (seen.append(rows.rdd.getNumPartitions()), process(self, rows, batch)))
    monkeypatch.setattr(faults, "shares", lambda *a: 5)
    found = {r.place: r.n for r in QUERIES["events_cleanup"](spark, sf_dir).collect()}
    assert seen[0] == 5
    assert found == {"webhook_events": 32, "users": 35, "assessments": 35}


def test_enrolment_export_is_written_by_tasks_of_its_size(spark, tmp_path, monkeypatch):
    sf_dir, paths = _tables(spark, tmp_path), []
    scratch = sources.session.scratch_path
    monkeypatch.setattr(sources.session, "scratch_path", lambda s, label: paths.append(scratch(s, label)) or paths[-1])
    monkeypatch.setattr(sources, "shares", lambda *a: 7)
    rows = QUERIES["csv_enrolments_scan"](spark, sf_dir)
    assert len([n for n in children(spark, paths[0]) if n.endswith(".csv")]) == 7
    assert sorted(r.source_row for r in rows.collect()) == list(range(70))  # five orders have no customer


def test_landed_pages_are_packed_and_their_rows_dealt_before_they_are_text(spark, tmp_path, monkeypatch):
    sf_dir, paths, plans = _tables(spark, tmp_path), [], []
    write = DataFrameWriter.text

    def written(self, path, *args, **options):
        paths.append(path)
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "text", written)
    monkeypatch.setattr(fixtures, "shares", lambda *a: 7)
    rows = QUERIES["json_rows_unwrap"](spark, sf_dir)
    assert [n.endswith(".txt.snappy") for n in children(spark, paths[0]) if n.startswith("part-")] == [True] * 7
    assert "hashpartitioning(l_orderkey" in plans[0] and "hashpartitioning(k_order" not in plans[0]
    assert sorted(r.student_comments for r in rows.collect()) == sorted(f"{i % 40}:{i % 7 + 1}:{i}" for i in range(80))


def test_purchases_are_dealt_by_customer_once(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path)
    rows = QUERIES["transactions_upsert_webhook"](spark, sf_dir)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(o_custkey" in plan and "hashpartitioning(user_id" not in plan


def test_report_reads_first_copies_of_the_events_that_it_folds(spark, tmp_path):
    kinds = ["signup", "purchase", "view", "click", "other"]
    rows = [(i, datetime.datetime(2024, 1, 1 + i % 28, i % 24), i % 50, kinds[i % 5], i / 7, "{}") for i in range(1, 400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(
        1).write.parquet(f"{tmp_path}/events.parquet")
    whole = entities.events(spark, str(tmp_path)).withColumn("data", F.to_json("data"))
    mine = reports.report_events(spark, str(tmp_path))
    assert mine.columns == ["seq", "received_at", "event_id", "event_type", "event_epoch", "data"]
    folded = whole.filter("event_type LIKE 'session.%' OR event_type LIKE 'assessments.%' OR event_type LIKE 'certificate.%'").select(mine.columns)
    assert sorted(map(repr, mine.collect())) == sorted(map(repr, folded.collect()))
    # One file of events, four tasks at least.
    assert messages(spark, str(tmp_path), dealt=True).rdd.getNumPartitions() >= 4 > messages(spark, str(tmp_path)).rdd.getNumPartitions()
