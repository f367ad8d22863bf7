"""Attendance tables on disk into which pulls are loaded, each touching its own dates and batches alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tutorlake.operators import upsert
from tutorlake.operators.policies import ATTENDANCE_RAW, CLASS_ATTENDANCE, TableRule
from tutorlake.plans import attendance
from tutorlake.session import stored
from tutorlake.streaming.tables import DatedTable, MergedTable, StateTable

_KEYS = list(ATTENDANCE_RAW.keys)


class AttendanceStore:
    """Bronze rows by pull date, class records by batch, and an index of the date at which each bronze row lies.

    A pull reads and rewrites the dates that it brings and those from which its rows move, and the batches of its rows.
    Loads are numbered; a load that runs again starts from the state before itself and leaves the same tables.  ``days`` is how
    many dates share a folder: one for daily pulls, more for a history of many small dates.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, fan_in: int = 8, days: int = 1):
        self.spark = spark
        self.bronze = DatedTable(spark, f"{root}/bronze/attendance_raw", "pull_date", days)
        self.dates = MergedTable(spark, f"{root}/bronze/attendance_dates", TableRule(
            keys=ATTENDANCE_RAW.keys, policies={"pull_date": upsert.LAST}), buckets, fan_in)
        self.classes = StateTable(spark, f"{root}/silver/class_attendance", ["batch_id"], buckets)

    def load(self, rows: DataFrame, loaded_at: Column, number: int, late_counts: bool = False) -> DataFrame:
        """Take in the rows (with ``is_staff``) of one or more pull dates; returns what came, as ``ingest_metrics``."""
        # Rows of one class lie together in the files, and so in what is shuffled from them: both pack to much less.
        needed = [c for c in rows.columns if c in (*_KEYS, *ATTENDANCE_RAW.policies, "seq")]
        own = rows.filter(~F.col("is_staff")).select(*needed).withColumn("loaded_at", loaded_at)
        saved = stored(own.sortWithinPartitions("batch_id", "class_id"), "pull")
        found = saved.select("pull_date", self.bronze.bucket().alias("day")).distinct().collect()
        days = sorted({r.day for r in found})
        latest = stored(saved.groupBy(*_KEYS).agg(F.max("pull_date").alias("pull_date"), F.count("*").alias("n")), "pull-keys")
        met = self._met(latest, number)
        left = set(self.bronze.touched(met.filter("known")))
        touched = sorted(left | set(days))
        before = self.bronze.read(number, touched)
        merged = attendance.upsert_raw(saved, before, met)
        # Only dates that rows leave can lose all their rows.
        empty = sorted(set(touched) - set(self.bronze.touched(merged))) if left - set(days) else []
        self.bronze.write_some(merged, number, empty, len(touched))
        self.dates.append(latest.select(*_KEYS, "pull_date", F.lit(0).cast("long").alias("seq")), number)

        mine = self.bronze.read(number + 1, days)
        if mine is not None:
            dates = [r.pull_date for r in found if r.pull_date is not None]
            self._classes(mine.filter(F.col("pull_date").isin(dates)), number, late_counts)
        self.bronze.expire(number)
        self.classes.expire(number)
        return attendance.ingest_metrics(rows)

    def _met(self, latest: DataFrame, number: int) -> DataFrame:
        """Keys that the pull has several times, and those ``known`` from before with the date at which they lie."""
        met = latest.filter("n > 1").select(*_KEYS, "pull_date", F.lit(False).alias("known"))
        there = self.dates.lookup(latest.select(*_KEYS), number)
        if there is not None:
            met = met.unionByName(there.select(*_KEYS, "pull_date", F.lit(True).alias("known")))
        return stored(met, "pull-met")

    def _classes(self, mine: DataFrame, number: int, late_counts: bool) -> None:
        # Dealt out by class once, rows reach their summary, its bundle and its last pull without a further shuffle.
        summary = attendance.summarise(mine.repartition("batch_id", "class_id"), late_counts)
        new = stored(attendance.upsert_classes(summary), "attendance-summary")
        there = self.classes.read(number, self.classes.touched(mine))
        if there is None:
            merged = new.withColumn("class_number", F.lit(None).cast("int"))
        else:
            rule = CLASS_ATTENDANCE
            merged = upsert.apply(there, new.withColumn("__pull", F.col("pull_date")), rule.keys, ["__pull"], rule.policies, changed=new)
        batches = stored(mine.select("batch_id").distinct(), "pull-batches")
        self.classes.write(attendance.number_classes(stored(merged, "attendance-classes"), batches), number)
