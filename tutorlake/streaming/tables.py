"""Tables that micro-batches write, and can write again after a failure.

``EventTable`` holds single events and only gets folders added.  ``MergedTable`` holds one row per key by merge on read: a
micro-batch appends its changes, readers fold base and changes, and now and then the changes are folded into the base,
a ``StateTable`` of buckets of which only touched ones are rewritten.  Every folder carries the number of its
micro-batch; a repeated micro-batch replaces its own folder, so nothing is applied twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tutorlake.operators import upsert
from tutorlake.operators.policies import TableRule

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def mark(spark: SparkSession, path: str) -> None:
    """Make a folder, which either is there afterwards or not: a switch in one step."""
    system, folder = _file_system(spark, path)
    system.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from the file system's own records."""
    system, folder = _file_system(spark, path)
    return system.getContentSummary(folder).getLength() if system.exists(folder) else 0


def numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``<name>=<number>`` below a path, ascending."""
    return sorted(int(n.split("=")[1]) for n in children(spark, path) if n.startswith(f"{name}="))


def finished(spark: SparkSession, path: str) -> bool:
    return "_SUCCESS" in children(spark, path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, on whatever file system it is; none when it is missing."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class EventTable:
    """Rows of single events, each of which arrives once: a micro-batch adds its own folder and rewrites nothing.

    Deleted events are listed beside the table, so that a repeated micro-batch does not bring them back.
    """

    def __init__(self, spark: SparkSession, path: str, folder: str = "version"):
        self.spark, self.path, self.folder = spark, path, folder

    def read(self, before: int | None = None) -> DataFrame | None:
        paths = [f"{self.path}/{self.folder}={n}" for n in numbers(self.spark, self.path, self.folder) if before is None or n < before]
        try:
            rows = self.spark.read.option("basePath", self.path).parquet(*paths).drop(self.folder) if paths else None
        except AnalysisException as missing:
            if missing.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            rows = None  # all micro-batches were empty
        if rows is None:
            return None
        gone = [f"{self.path}.deletes/{n}" for n in children(self.spark, f"{self.path}.deletes") if finished(self.spark, f"{self.path}.deletes/{n}")]
        return rows.join(self.spark.read.parquet(*gone), "event_id", "left_anti").select(rows.columns) if gone else rows

    def write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{self.folder}={version}")

    def delete(self, condition: Column) -> None:
        """Events for which the condition holds are gone for every reader."""
        rows = self.read()
        if rows is not None:
            rows.filter(condition).select("event_id").write.parquet(next_folder(self.spark, f"{self.path}.deletes"))


def next_folder(spark: SparkSession, path: str, name: str = "number") -> str:
    taken = numbers(spark, path, name)
    return f"{path}/{name}={taken[-1] + 1 if taken else 0}"


class StateTable:
    """The number of buckets belongs to the stored table; opening it with another number is refused."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | str):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        kept = children(spark, f"{path}.buckets")
        if kept and kept != [str(buckets)]:
            raise ValueError(f"{path} has {kept[0]} buckets, not {buckets}")

    def _current(self, before: int | None) -> dict[int, int]:
        """Newest finished version of every bucket; folder names only, no data is read."""
        newest: dict[int, int] = {}
        for version in numbers(self.spark, self.path, "version"):
            if before is not None and version >= before:
                break
            names = children(self.spark, f"{self.path}/version={version}")
            if "_SUCCESS" in names:
                newest.update({int(n.split("=")[1]): version for n in names if n.startswith("bucket=")})
                for bucket in numbers(self.spark, f"{self.path}.empty/version={version}", "bucket"):
                    newest.pop(bucket, None)
        return newest

    def read(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Current rows, or those of some buckets; None while there are none."""
        newest = self._current(before)
        chosen = newest if buckets is None else {b: v for b, v in newest.items() if b in set(buckets)}
        if not chosen:
            return None
        paths = [f"{self.path}/version={v}/bucket={b}" for b, v in sorted(chosen.items())]
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("version", "bucket")

    def bucket(self) -> Column:
        return bucket_of(self.keys, self.buckets)

    def laid_out(self, rows: DataFrame) -> DataFrame:
        """Rows with their ``bucket``, as they are written: few files per bucket, and a large bucket is written by several tasks."""
        return rows.hint("rebalance", "bucket")

    def touched(self, rows: DataFrame) -> list[int]:
        """Bucket numbers of some rows; at most as many as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def finished_version(self, before: int | None = None) -> int | None:
        """The newest version that is whole."""
        for version in reversed(numbers(self.spark, self.path, "version")):
            if (before is None or version < before) and finished(self.spark, f"{self.path}/version={version}"):
                return version
        return None

    def size(self) -> int:
        return sum(bytes_below(self.spark, f"{self.path}/version={v}/bucket={b}") for b, v in self._current(None).items())

    def write(self, rows: DataFrame, version: int, empty: Sequence[int] = ()) -> None:
        """Replace the buckets that the rows fall into; ``empty`` names buckets that have lost all their rows."""
        self._replace(self.laid_out(rows.withColumn("bucket", self.bucket())), version, empty)

    def _replace(self, rows: DataFrame, version: int, empty: Sequence[int]) -> None:
        mark(self.spark, f"{self.path}.buckets/{self.buckets}")
        for bucket in empty:  # counts only once the version is whole
            mark(self.spark, f"{self.path}.empty/version={version}/bucket={bucket}")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/version={version}")

    def expire(self, before: int) -> None:
        """Remove versions below ``before`` that hold no bucket's state of that time.

        What remains is at most one version per bucket, however long the stream runs.
        """
        kept = set(self._current(before).values())
        for version in numbers(self.spark, self.path, "version"):
            if version < before and version not in kept:
                remove(self.spark, f"{self.path}/version={version}")


class DatedTable(StateTable):
    """A state table whose buckets are stretches of ``days`` of a date column."""

    #: Bucket of rows without a date.
    NO_DAY = -(10**7)
    #: Buckets up to which a task writes all of them side by side, in the order in which it reads their rows.
    SIDE_BY_SIDE = 64

    def __init__(self, spark: SparkSession, path: str, day: str, days: int = 1):
        super().__init__(spark, path, [day], f"{days}-days")
        self.days = days

    def bucket(self) -> Column:
        return F.coalesce(F.floor(F.unix_date(F.col(self.keys[0])) / self.days).cast("int"), F.lit(self.NO_DAY))

    def write_some(self, rows: DataFrame, version: int, empty: Sequence[int], buckets: int) -> None:
        """``write`` of rows that fall into so many buckets: where they are few, whole rows are neither dealt out nor sorted by bucket.

        Then a bucket gets as many files as tasks hold rows of it; else few, as ``laid_out`` says.
        """
        if buckets > self.SIDE_BY_SIDE:
            self.write(rows, version, empty)
            return
        kept = self.spark.conf.get(_WRITERS)
        self.spark.conf.set(_WRITERS, str(self.SIDE_BY_SIDE))
        try:
            self._replace(rows.withColumn("bucket", self.bucket()), version, empty)
        finally:
            self.spark.conf.set(_WRITERS, kept)


class MergedTable:
    """One row per key, kept as a base and the changes since.

    What a micro-batch writes follows the micro-batch: its changes, in a folder ``versions=n-n``.  ``fan_in`` neighbouring
    folders of one size class are joined into one, so that readers meet few of them, and once the changes weigh a
    ``share`` of the base they are folded into it; both cost each change a bounded number of further writes.  Folders that
    are superseded stay until the next fold, for readers that have begun.

    A deletion writes the keys it found beside the table.  It voids what came up to its version, so neither a repeated
    micro-batch nor a later fold brings the rows back, and changes that come after it count.
    """

    def __init__(self, spark: SparkSession, path: str, rule: TableRule, buckets: int, fan_in: int = 8, share: float = 0.5):
        if fan_in < 2:
            raise ValueError("at least two folders are joined")
        self.spark, self.path, self.rule, self.fan_in, self.share = spark, path, rule, fan_in, share
        self.base = StateTable(spark, path, rule.keys, buckets)
        self.changes = f"{path}.changes"

    def _spans(self) -> list[tuple[int, int]]:
        names = [n.split("=")[1].split("-") for n in children(self.spark, self.changes) if n.startswith("versions=")]
        return sorted((int(a), int(b)) for a, b in names)

    def _folder(self, span: tuple[int, int]) -> str:
        return f"{self.changes}/versions={span[0]}-{span[1]}"

    def _pending(self, after: int, before: int | None) -> list[tuple[int, int]]:
        """Finished folders that cover the versions after the base; the widest where several begin alike."""
        chosen: list[tuple[int, int]] = []
        for first, last in sorted(self._spans(), key=lambda s: (s[0], -s[1])):
            free = first > (chosen[-1][1] if chosen else after)
            if free and (before is None or last < before) and finished(self.spark, self._folder((first, last))):
                chosen.append((first, last))
        return chosen

    def _state(self, before: int | None = None) -> tuple[int, list[tuple[int, int]]]:
        base = self.base.finished_version(before)
        after = -1 if base is None else base
        return after, self._pending(after, before)

    def _deletes(self, since: int) -> DataFrame | None:
        """Deleted keys with the version up to which they are void."""
        path = f"{self.path}.deletes"
        wanted = [n for n in numbers(self.spark, path, "version") if n >= since]
        paths = [f"{path}/version={v}/{n}" for v in wanted for n in children(self.spark, f"{path}/version={v}")
                 if finished(self.spark, f"{path}/version={v}/{n}")]
        if not paths:
            return None
        found = self.spark.read.option("basePath", path).parquet(*paths)
        names = [c for c in found.columns if c not in ("version", "number")]
        return found.select(*[F.col(c).alias(f"__gone_{c}") for c in names], F.col("version").alias("__gone_version")).distinct()

    def _without(self, rows: DataFrame, gone: DataFrame | None, version: Column) -> DataFrame:
        if gone is None:
            return rows
        same, lone = version <= F.col("__gone_version"), F.lit(False)
        for key in self.rule.keys:
            same, lone = same & F.col(key).eqNullSafe(F.col(f"__gone_{key}")), lone | F.col(key).isNull()
        if "__gone_event_id" in gone.columns and "event_id" not in self.rule.keys:
            # A key with a NULL part does not tell its rows apart; their events do.
            same = same & (~lone | F.col("event_id").eqNullSafe(F.col("__gone_event_id")))
        return rows.join(gone, same, "left_anti")

    def _changed(self, spans: list[tuple[int, int]]) -> DataFrame | None:
        parts = [self.spark.read.parquet(self._folder(span)) for span in spans]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _merged(self, before: int | None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        after, spans = self._state(before)
        gone = self._deletes(max(after, 0))
        base, changed = self.base.read(before, buckets), self._changed(spans)
        if base is not None:
            base = self._without(base, gone, F.lit(after))
        if changed is None:
            return base
        changed = self._without(changed, gone, F.col("__version"))
        order, rule = ["__version", "seq"], self.rule
        if base is None:
            return upsert.fold(changed, rule.keys, order, rule.policies)
        return upsert.apply(base, changed, rule.keys, order, rule.policies)

    def read(self, before: int | None = None) -> DataFrame | None:
        """Current rows, or those before a version; None while there are none."""
        return self._merged(before)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """Current rows of some keys; of the base only their buckets are read."""
        rows = self._merged(before, self.base.touched(keys))
        return None if rows is None else rows.join(keys, list(self.rule.keys), "left_semi")

    def append(self, rows: DataFrame, version: int) -> None:
        """Add the changes of a micro-batch, then fold or join folders where enough have gathered."""
        mark(self.spark, f"{self.path}.buckets/{self.base.buckets}")
        rows.withColumn("__version", F.lit(version).cast("long")).write.mode("overwrite").parquet(self._folder((version, version)))
        self._maintain(version)

    def _maintain(self, version: int) -> None:
        _, spans = self._state(version + 1)
        if len(spans) < self.fan_in:
            return
        weight = sum(bytes_below(self.spark, self._folder(span)) for span in spans)
        if weight >= self.share * self.base.size():
            self.fold(version)
            return
        # Neighbours of one size class, from the newest back; joined they may be the last of the next class.
        def rank(span: tuple[int, int]) -> int:
            return next(k for k in range(64) if span[1] - span[0] + 1 <= self.fan_in ** k)

        while len(newest := [s for s in spans[-self.fan_in:] if rank(s) == rank(spans[-1])]) == self.fan_in:
            joined = (newest[0][0], newest[-1][1])
            self._changed(newest).write.mode("overwrite").parquet(self._folder(joined))
            spans = [*spans[:-self.fan_in], joined]

    def fold(self, version: int) -> None:
        """Fold all changes up to a version into the base; only buckets with changes or deletions are rewritten."""
        after, spans = self._state(version + 1)
        if not spans:
            return
        keys, gone = self._changed(spans).select(*self.rule.keys), self._deletes(max(after, 0))
        if gone is not None:
            keys = keys.unionByName(gone.select(*[F.col(f"__gone_{k}").alias(k) for k in self.rule.keys]))
        touched = self.base.touched(keys)
        state = self._merged(version + 1, touched)
        left = touched if gone is None else self.base.touched(state)
        self.base.write(state, version, sorted(set(touched) - set(left)))
        self.base.expire(version)
        for old in numbers(self.spark, f"{self.path}.deletes", "version"):
            if old < after:
                remove(self.spark, f"{self.path}.deletes/version={old}")
        for first, last in self._spans():
            if last <= after:
                remove(self.spark, self._folder((first, last)))

    def newest_version(self) -> int | None:
        """The last version that is stored."""
        after, spans = self._state()
        return spans[-1][1] if spans else after if after >= 0 else None

    def delete(self, condition: Column) -> None:
        """Rows for which the condition holds are gone, with all that was known of their keys up to now."""
        version, rows = self.newest_version(), self.read()
        if rows is not None:
            names = [*self.rule.keys, *[c for c in ("event_id",) if c in rows.columns and c not in self.rule.keys]]
            rows.filter(condition).select(*names).write.parquet(next_folder(self.spark, f"{self.path}.deletes/version={version}"))
