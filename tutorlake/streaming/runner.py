"""The event pipeline as a Structured Streaming query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tutorlake.operators import dedup, envelope, upsert
from tutorlake.operators.policies import ROUTED_TABLES, TableRule
from tutorlake.plans import routing
from tutorlake.sources import sinks
from tutorlake.streaming.tables import EventTable, MergedTable, children, finished, mark, next_folder, numbers, remove

#: Landed messages: arrival number, arrival time, content type and raw body.
MESSAGE_SCHEMA = "seq bigint, received_at timestamp, content_type string, body string"


def read_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


#: Keyed state of the stream is kept here, on the executors' disks with its changes in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARSED = "event_id string, event_type string, is_live boolean, data string, event_epoch bigint, reject_reason string"


class EventPipeline:
    """Bronze log, dead letters, entity tables and retry queue below ``root``.

    Every output of a micro-batch goes to a folder of its own number and is replaced when the micro-batch runs again.  What
    a micro-batch reads and writes follows its own size: known event ids are keyed state of the stream, entity tables and
    the queue of open events are merged on read.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, watermark: str | None = None, fan_in: int = 8):
        self.spark, self.root, self.buckets, self.watermark, self.fan_in = spark, root, buckets, watermark, fan_in
        self.log = EventTable(spark, f"{root}/bronze/webhook_events", "batch")

    # --- places ---

    def _generation(self, name: str) -> int:
        return max((int(n) for n in children(self.spark, f"{self.root}/silver/{name}.generation")), default=0)

    def table(self, name: str, generation: int | None = None) -> MergedTable | EventTable:
        number = self._generation(name) if generation is None else generation
        path = f"{self.root}/silver/{name}" + (f".{number}" if number else "")
        if ROUTED_TABLES[name].keys == ("event_id",):
            return EventTable(self.spark, path)
        return MergedTable(self.spark, path, ROUTED_TABLES[name], self.buckets, self.fan_in)

    def _queue(self) -> MergedTable:
        """Open events by id, whole and with their reason; a closed one is a row that says so."""
        columns = [f.name for f in StructType.fromDDL(f"{MESSAGE_SCHEMA}, {_PARSED}").fields if f.name not in ("event_id", "reject_reason")]
        rule = TableRule(keys=("event_id",), policies=upsert.replace_all([*columns, "number", "route", "problem", "closed"]))
        return MergedTable(self.spark, f"{self.root}/retry", rule, self.buckets, self.fan_in)

    def _log_path(self, batch: int) -> str:
        return f"{self.log.path}/batch={batch}"

    # --- a micro-batch ---

    @staticmethod
    def parsed(messages: DataFrame) -> DataFrame:
        """Messages with their envelope's columns, the data as text."""
        return envelope.parse(messages).withColumn("data", F.to_json("data"))

    def process(self, messages: DataFrame, batch: int) -> None:
        """Load landed messages as one micro-batch, without a stream; safe to repeat.

        There is no keyed state here, so the ids of the whole log are asked.  Use ``start`` for a stream.
        """
        # Both outputs come from one reading of the bodies.
        parsed = self.parsed(messages).persist()
        events = dedup.first_seen(envelope.accepted(parsed), ["event_id"], ["seq"]).persist()
        self._load(envelope.rejects(parsed), self._without_known(events, self.log.read(before=batch)), batch)
        events.unpersist()
        parsed.unpersist()

    def _process_unique(self, parsed: DataFrame, batch: int) -> None:
        """A micro-batch of the stream, whose events never came before."""
        parsed = parsed.persist()
        self._load(envelope.rejects(parsed), envelope.accepted(parsed), batch)
        parsed.unpersist()

    def _load(self, rejects: DataFrame, fresh: DataFrame, batch: int) -> None:
        sinks.write_dead_letters(rejects, f"{self.root}/bronze/failed_events/batch={batch}", "overwrite")
        routed = fresh.withColumn("route", envelope.route(F.col("event_type")))
        routed.write.mode("overwrite").partitionBy("route").parquet(self._log_path(batch))
        self._route(batch, routed.schema)

    @staticmethod
    def _without_known(events: DataFrame, earlier: DataFrame | None) -> DataFrame:
        """Events whose id the log lacks.

        The log's ids are reduced to those of this micro-batch first; by their
        measured size Spark broadcasts the batch's ids for that or shuffles both.
        """
        if earlier is None:
            return events
        known = earlier.select("event_id").join(events.select("event_id"), "event_id", "left_semi")
        return events.join(known, "event_id", "left_anti")

    def _handed_in(self, batch: int) -> list[str]:
        """Folders of mended events that this micro-batch tries: those it has taken before, or all that none has taken."""
        taken = {n: b for b in numbers(self.spark, f"{self.root}/retry.taken", "batch")
                 for n in numbers(self.spark, f"{self.root}/retry.taken/batch={b}", "number")}
        path, chosen = f"{self.root}/retry.mended", []
        for number in numbers(self.spark, path, "number"):
            if finished(self.spark, f"{path}/number={number}") and taken.get(number, batch) == batch:
                mark(self.spark, f"{self.root}/retry.taken/batch={batch}/number={number}")
                chosen.append(f"{path}/number={number}")
        return chosen

    def _route(self, batch: int, schema: StructType) -> None:
        """New and mended events into their tables; those that cannot enter wait in the queue until they are handed in again."""
        # The log is partitioned by route, so each table reads only its own events.
        path, mended = self._log_path(batch), self._handed_in(batch)
        present = {n.split("=")[1] for n in children(self.spark, path) if n.startswith("route=")}
        logged = self.spark.read.schema(schema).parquet(path).withColumn("number", F.lit(0))
        if mended:
            base = self.spark.read.schema(schema).parquet(*mended)
            again = base.withColumn("number", F.regexp_extract(F.col("_metadata.file_path"), r"number=(\d+)", 1).cast("int") + 1)
            # Of an event handed in several times the last counts.
            newest = [F.max_by(F.struct(*[c for c in again.columns if c != "event_id"]), "number").alias("row")]
            again = again.groupBy("event_id").agg(*newest).select("event_id", "row.*").persist()
            present |= {row.route for row in again.select("route").distinct().collect()}
            logged = logged.unionByName(again)
        logged = logged.withColumn("data", F.parse_json("data"))
        typed = {
            name: routing.entity_rows(logged.filter(F.col("route") == name), name).persist()
            for name in ROUTED_TABLES if name in present}
        for name, rows in typed.items():
            self._update(name, routing.sound(rows), batch)
        open_events = [routing.problems(rows, name).select("event_id", "problem") for name, rows in typed.items()]
        none = self.spark.createDataFrame([], "event_id string, problem string")
        whole = logged.withColumn("data", F.to_json("data"))
        queue = whole.join(reduce(DataFrame.unionByName, open_events, none), "event_id", "left")
        queue = queue.filter(F.col("problem").isNotNull() | (F.col("number") > 0)).withColumn("closed", F.col("problem").isNull())
        self._queue().append(queue, batch)
        for rows in (*typed.values(), *([again] if mended else [])):
            rows.unpersist()

    def _update(self, name: str, rows: DataFrame, batch: int) -> None:
        rule, table = ROUTED_TABLES[name], self.table(name)
        if isinstance(table, EventTable):
            table.write(upsert.fold(rows, rule.keys, ["seq"], rule.policies), batch)
        else:
            table.append(rows, batch)

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Run over a stream of messages.

        The ids of all events are keyed state of the stream: a micro-batch looks up its own ids and reads nothing of the
        log.  With a watermark, repeats within that delay are dropped by the stream's own bounded state (any copy of one
        micro-batch may stay) and the log is asked for the rest.  Messages without an id never count as repeats.
        """
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        if self.watermark:
            own = F.concat(F.lit("message "), F.col("seq").cast("string"))
            ids = envelope.parse(messages).select(*messages.columns, F.coalesce("event_id", own).alias("__id"))
            messages = dedup.stream_first(ids, "__id", ("received_at", self.watermark)).drop("__id")
            writer = messages.writeStream.foreachBatch(self.process)
        else:
            if not children(self.spark, checkpoint) and children(self.spark, self.log.path):
                raise ValueError(f"{self.root} holds events that a new checkpoint does not know; rebuild it below another root")
            accepted = F.col("reject_reason").isNull()
            unique = dedup.first_ever(self.parsed(messages), "event_id", "seq", accepted)
            writer = unique.writeStream.foreachBatch(self._process_unique)
        writer = writer.option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    # --- what is stored ---

    def events(self) -> DataFrame:
        """All logged events, ready for routing; a mended event as it was handed in last."""
        logged = self.log.read().drop("route")
        folders = [f"{self.root}/retry.mended/number={n}" for n in numbers(self.spark, f"{self.root}/retry.mended", "number")]
        folders = [f for f in folders if finished(self.spark, f)]
        if folders:
            # Later hand-ins replace earlier ones.
            again = self.spark.read.schema(logged.schema).parquet(*folders).withColumn(
                "at", F.regexp_extract(F.col("_metadata.file_path"), r"number=(\d+)", 1).cast("int"))
            row = F.max_by(F.struct(*[c for c in logged.columns if c != "event_id"]), "at").alias("row")
            again = again.groupBy("event_id").agg(row).select("event_id", "row.*").select(logged.columns)
            known = again.join(logged.select("event_id"), "event_id", "left_semi")
            logged = logged.join(again.select("event_id"), "event_id", "left_anti").unionByName(known)
        return logged.withColumn("data", F.parse_json("data"))

    def rebuild(self, table: str) -> DataFrame:
        """State of a table from the whole log and an empty target."""
        return routing.fold_table(self.events(), table)

    def rebuild_in_place(self, name: str) -> None:
        """Build a table anew from the log and let it take the old one's place.

        The new generation is written beside the live one, and one marker switches all readers; a crash before it leaves
        the old one.  Run it between micro-batches: what one of them adds meanwhile is noticed and built again.
        """
        generation = self._generation(name) + 1
        while True:
            batches = [b for b in numbers(self.spark, self.log.path, "batch") if finished(self.spark, self._log_path(b))]
            if not batches:
                return
            table = self.table(name, generation)
            for part in ("", ".changes", ".deletes", ".empty", ".buckets"):  # left by a rebuild that did not finish
                remove(self.spark, table.path + part)
            table = self.table(name, generation)
            (table if isinstance(table, EventTable) else table.base).write(self.rebuild(name), batches[-1])
            if batches[-1] == max(numbers(self.spark, self.log.path, "batch")):
                break
        mark(self.spark, f"{self.root}/silver/{name}.generation/{generation}")

    def clean(self, found: dict[str, Column]) -> None:
        """Delete rows by predicate: from the log (``webhook_events``) and from entity tables, by name.

        Deletions are kept beside the tables, so that a repeated micro-batch, a fold or a rebuild do not bring rows back.
        The ids of deleted events stay known to the stream.
        """
        for name, condition in found.items():
            (self.log if name == "webhook_events" else self.table(name)).delete(condition)

    def failed(self) -> DataFrame:
        return self.spark.read.json(f"{self.root}/bronze/failed_events/*")

    def retry(self) -> DataFrame:
        """Events that are open after the last micro-batch, whole and with their reason."""
        queue = self._queue()
        version = queue.newest_version()
        return queue.read().filter(~F.col("closed")).drop("closed", "number").withColumn("batch", F.lit(version))

    def mend(self, events: DataFrame | None = None) -> None:
        """Hand in open events again, mended or (without any given) as they are; the next micro-batch tries them."""
        rows = self.retry() if events is None else events
        names = [c for c in rows.columns if c not in ("problem", "batch")]
        rows.select(*names).write.parquet(next_folder(self.spark, f"{self.root}/retry.mended"))


def replay(spark: SparkSession, path: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recover dead-letter files: new events, and the messages that still fail.

    Each line holds ``reason``, ``body`` and ``type``; ``seq`` keeps arrival order.
    """
    lines = spark.read.schema("seq bigint, reason string, body string, type string").json(path)
    parsed = envelope.parse(lines)
    recovered = dedup.only_new(known, envelope.accepted(parsed), ["event_id"], ["seq"])
    return recovered, envelope.rejects(parsed)
