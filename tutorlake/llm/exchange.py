"""Packed exchange of hashes between pieces of a corpus.

One shuffled row per hash would cost several times the corpus.  Here every scan task cuts its partition into chunks of
bounded size, sorts the distinct hashes of a chunk, cuts them into ranges and ships each range as one row of packed
differences.  The task of a range merges the chunks' lists and answers every chunk with one small number per hash.  The
answers meet the chunk's texts again in a cogroup by chunk.  A hash that a third of all documents hold comes once per
chunk, never once per document.  The two scans deal rows to the same chunks because they read the same stored files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import cuts, pack, pack_plain, unpack, unpack_plain

#: Text bytes of a chunk; one longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20

#: (hashes of a chunk, ascending and distinct; one number per hash; numbers that every range gets, such as ids)
Announce = Callable[[list[tuple]], tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]
#: (hashes, index of the chunk of each, number of each, extra numbers by chunk) -> one answer per hash
Answer = Callable[[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]], np.ndarray]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(chunk id, rows) of this task's partition; a row is a tuple of the columns, the text last."""
    part, count, size, rows = TaskContext.get().partitionId(), 0, 0, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            length = len(row[-1] or "")
            if rows and size + length > CHUNK_BYTES:
                yield part << 24 | count, rows
                count, size, rows = count + 1, 0, []
            rows.append(row)
            size += length
    if rows:
        yield part << 24 | count, rows


def range_count(docs: DataFrame) -> int:
    """Ranges grow with the scan partitions, so that a range holds about half a partition's hashes."""
    return max(16, 2 * docs.rdd.getNumPartitions())


def answers(docs: DataFrame, announce: Announce, answer: Answer, buckets: int) -> DataFrame:
    """``chunk``, ``bucket``, ``flags``: the packed answers for each chunk's hashes in the range ``bucket``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunks(batches):
            yield from rows_of(chunk, *announce(rows), buckets)

    return answered(docs.mapInArrow(send, SENT), answer)


SENT = "chunk long, bucket int, hashes binary, numbers binary, extra binary"
SENT_KINDS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("numbers", pa.binary()),
                        ("extra", pa.binary())])
ANSWERED = "chunk long, bucket int, flags binary"


def rows_of(chunk: int, hashes: np.ndarray, numbers: np.ndarray | None, extra: np.ndarray | None,
             buckets: int) -> Iterator[pa.RecordBatch]:
    at = cuts(hashes, buckets)
    packed = pack_plain(extra) if extra is not None else None
    out = []
    for b in range(buckets):
        lo, hi = int(at[b]), int(at[b + 1])
        if hi > lo:
            out.append((b, pack(hashes[lo:hi]), None if numbers is None else pack_plain(numbers[lo:hi])))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(out), pa.int64()), pa.array([r[0] for r in out], pa.int32()),
             pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary()),
             pa.array([packed] * len(out), pa.binary())], ["chunk", "bucket", "hashes", "numbers", "extra"])


def answered(sent: DataFrame, answer: Answer) -> DataFrame:
    def merge(group: pa.Table) -> pa.Table:
        lists = [unpack(x) for x in group.column("hashes").to_pylist()]
        numbers = group.column("numbers").to_pylist()
        extra = [unpack_plain(x) if x is not None else None for x in group.column("extra").to_pylist()]
        every = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        values = (np.concatenate([unpack_plain(x) for x in numbers]) if numbers[0] is not None
                  else np.zeros(0, np.uint64))
        flags = answer(every, owner, values, extra)
        ends = np.cumsum([len(x) for x in lists])
        blobs = [pack_plain(flags[e - len(x):e].astype(np.uint64)) for x, e in zip(lists, ends)]
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                         "flags": pa.array(blobs, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(merge, ANSWERED)


def packed_texts(docs: DataFrame) -> DataFrame:
    """``chunk``, ``payload``: the rows of each chunk, compressed."""
    names = docs.columns
    schema = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in docs.schema.fields])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for chunk, rows in chunks(batches):
            table = pa.table(dict(zip(names, map(list, zip(*rows)))), schema=schema)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema) as writer:
                writer.write_table(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([squeeze.compress(sink.getvalue())], pa.binary())],
                ["chunk", "payload"])

    return docs.mapInArrow(send, "chunk long, payload binary")


def expect(answers: np.ndarray, hashes: np.ndarray) -> None:
    """Fails if the two scans did not see the same chunk; silent misalignment would give wrong answers."""
    if len(answers) != len(hashes):
        raise ValueError(f"{len(answers)} answers for {len(hashes)} hashes: the input was dealt out differently when read again")


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}


def open_payload(payload: bytes) -> list[tuple]:
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(payload)
    table = pa.ipc.open_stream(raw).read_all()
    return list(zip(*(table.column(i).to_pylist() for i in range(table.num_columns))))


def with_answers(docs: DataFrame, flags: DataFrame, build: Callable[[int, list[tuple], np.ndarray], pa.Table],
                 schema: str) -> DataFrame:
    """``build(chunk, rows, flags in the order of the chunk's ascending hashes)`` over every chunk."""

    def meet(texts: pa.Table, replies: pa.Table) -> pa.Table:
        order = np.argsort(np.array(replies.column("bucket").to_pylist(), np.int64), kind="stable")
        blobs = replies.column("flags").to_pylist()
        joined = np.concatenate([unpack_plain(blobs[i]) for i in order]) if blobs else np.empty(0, np.uint64)
        return build(texts.column("chunk")[0].as_py(), open_payload(texts.column("payload")[0].as_py()), joined)

    return (packed_texts(docs).groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(meet, schema))
