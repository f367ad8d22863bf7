"""Helpers of the corpus operators: words, global row numbers, linked components, packed hash exchange."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.session import stored

#: A word: what lies between blanks and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name like the given one that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows, stored with a number of their own, and the name of its column.  The numbers are unique, not gapless."""
    row = unused(df, "_row")
    return stored(df.withColumn(row, F.monotonically_increasing_id()), label), row


def word_count(text: str) -> Column:
    """Words of a text column as a long; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the characters that ``WORD`` excludes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = x ^ np.uint64(salt & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    if n not in _POWERS:
        _POWERS[n] = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    return _POWERS[n]


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The 64-bit hash of each run of ``width`` word hashes; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(_powers(width)):
        total += hashes[j:j + n] * factor
    return mix(total)


def batches_of(df_batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    for batch in df_batches:
        if batch.num_rows:
            yield {name: batch.column(i) for i, name in enumerate(batch.schema.names)}


def numbered(df: DataFrame, order: Sequence[str | Column], number: str, label: str = "numbered",
             partitions: int | None = None) -> DataFrame:
    """Rows with a gapless global number from 0 in the given order; no task sees more than its range.

    The rows are dealt out by ranges of the order and stored; a row's number is its place in its
    range plus the rows of the ranges before.  Only one count per range is gathered.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place, part, before = (unused(df, name) for name in ("_at", "_part", "_before"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn(place, F.monotonically_increasing_id()), label)
    counts = ranged.groupBy(F.shiftright(place, 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, starts = 0, []
    for row in sorted(counts, key=lambda r: r["part"]):
        starts.append((row["part"], total))
        total += row["n"]
    offsets = spark.createDataFrame(starts, f"{part} long, {before} long")
    return (ranged.withColumn(part, F.shiftright(place, 33)).join(F.broadcast(offsets), part)
            .withColumn(number, F.col(before) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))).drop(place, part, before))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``id`` and ``component`` (smallest id that links reach) of every node of undirected ``a``/``b`` edges.

    Each round every node takes the smallest label among its neighbours, then labels are followed
    one step (a label's own label), so that chains shorten by doubling.  Each round is stored, which cuts the lineage.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{label}-links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")),
                    f"{label}-0")
    step = 0
    while True:
        step += 1
        seen = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        hooked = (labels.join(seen, "id", "left")
                  .select("id", F.col("component").alias("old"), F.least("component", "near").alias("component")))
        # The old label moves too: every node is told what its label now points to.
        hooked = stored(hooked, f"{label}-{step}a")
        moved = hooked.groupBy(F.col("old").alias("root")).agg(F.min("component").alias("down"))
        jumped = (hooked.join(hooked.select(F.col("id").alias("component"), F.col("component").alias("next")),
                              "component", "left")
                  .join(stored(moved, f"{label}-{step}m"), F.col("old") == F.col("root"), "left")
                  .select("id", "old", F.least("component", "next", "down").alias("component")))
        jumped = stored(jumped, f"{label}-{step}")
        labels = jumped.select("id", "component")
        if not jumped.filter("old <> component").limit(1).count():
            return labels


# Packed exchange ------------------------------------------------------------
#
# One row per hash would cost several times the corpus in a shuffle.  Here a task sorts the hashes of a piece of its
# partition, cuts them by their leading bits and ships each cut as one row: differences of sorted numbers, packed.


def pack(sorted_numbers: np.ndarray) -> bytes:
    """Ascending unsigned numbers as packed differences."""
    import zstandard
    steps = np.diff(sorted_numbers, prepend=np.uint64(0)).astype(np.uint64)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    # Byte planes: the leading bytes of most differences are 0 and pack to nothing.
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    import zstandard
    width = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(width, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :width] = raw.T
    return np.cumsum(wide.view("<u8").ravel().astype(np.uint64), dtype=np.uint64)


def pack_plain(numbers: np.ndarray) -> bytes:
    """Any unsigned numbers, in order, packed by byte planes."""
    import zstandard
    numbers = numbers.astype("<u8")
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack_plain(blob: bytes) -> np.ndarray:
    import zstandard
    width = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(width, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :width] = raw.T
    return wide.view("<u8").ravel().astype(np.uint64)


def cuts(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the hashes of each of ``buckets`` equal ranges begin, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)])).astype(np.int64)


def scanned(df: DataFrame, label: str) -> DataFrame:
    """Rows that a second read deals to the same partitions in the same order.

    That holds for a plain reading of files; anything else, with a shuffle or a limit for instance, is stored first.
    """
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    plan = re.sub(r"Location: .*?, PartitionFilters", "", text.getvalue())
    plain = "FileScan " in plan and not re.search("Exchange|Join|Union|Limit|Sample|InMemoryTable|ExistingRDD|LocalTable|Python|Arrow", plan)
    return df if plain and df.inputFiles() else stored(df, label)


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
