"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get a gapless number in the order of their key.  A keyed Feistel network permutes the numbers; an image outside
the row count is permuted again until it falls inside, so the result is a permutation of exactly the rows.  Shard and
slot follow from the shuffled number by division, and any position can be computed from its row number alone.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import numbered

SHARDS, SEED, ROUNDS = 40, 20240607, 6
#: Bytes that a row takes beside its text.
OVERHEAD = 16


def domain(rows: int) -> tuple[int, int]:
    """Sides of the smallest near-square rectangle that holds the rows, so that few images fall outside."""
    side = max(1, isqrt(max(rows - 1, 0)) + 1)
    return min(((a, max(1, -(-rows // a))) for a in range(side, side + min(side, 1000) + 1)),
               key=lambda ab: (ab[0] * ab[1] - rows, ab[0]))


def _encrypt(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass: the halves x div b and x mod b take turns in being shifted by a hash of the other."""
    def wide(n: int) -> Column:
        return F.lit(n).cast("long")

    low = F.pmod(x, wide(b))
    # Spark divides to double; the quotient is a whole number, exact to 2^53 rows.
    start = F.struct(((x - low) / wide(b)).cast("long").alias("l"), low.alias("r"))

    def turn(halves: Column, i: Column) -> Column:
        left, right = halves["l"], halves["r"]
        moved_left = F.pmod(left + F.pmod(F.xxhash64(right, i, F.lit(seed)), wide(a)), wide(a))
        moved_right = F.pmod(right + F.pmod(F.xxhash64(left, i, F.lit(seed)), wide(b)), wide(b))
        even = i % 2 == 0
        return F.struct(F.when(even, moved_left).otherwise(left).alias("l"),
                        F.when(even, right).otherwise(moved_right).alias("r"))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, turn, lambda h: h["l"] * wide(b) + h["r"])


def permuted(number: Column, rows: int, seed: int = SEED) -> Column:
    """The shuffled place of a row number in ``0 .. rows - 1``.

    A walk leaves the rectangle's surplus after at most as many steps as the surplus has places, which bounds the loop;
    only the few numbers whose first image lies outside walk at all.
    """
    a, b = domain(rows)
    surplus = a * b - rows
    first = _encrypt(number, a, b, seed)
    if surplus <= 0:
        return first
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(surplus)), first,
                       lambda at, _: F.when(at < rows, at).otherwise(_encrypt(at, a, b, seed)))
    return F.when(first < rows, first).otherwise(walk)


def sharded(rows: DataFrame, order: Sequence[str | Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns and ``row_number``, ``position``, ``shard``, ``slot``.

    The law is that of rows: counts of shards differ by one at most.  ``order`` fixes the row numbers; rows equal in it
    are interchangeable.  Columns of the four names are replaced.
    """
    plain = rows.drop("row_number", "position", "shard", "slot")
    placed = numbered(plain, order, "row_number", "shard-rows")
    count = placed.count()
    if not count:
        return placed.withColumns({"position": F.lit(0).cast("long"), "shard": F.lit(0), "slot": F.lit(0).cast("long")})
    return (placed.withColumn("position", permuted(F.col("row_number"), count, seed))
            .withColumn("shard", (F.col("position") % shards).cast("int"))
            .withColumn("slot", F.expr(f"position div {int(shards)}").cast("long")))


def sharded_documents(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of every row.

    Size: UTF-8 bytes plus 16; a missing text has no bytes and checksum 0.  Rows are numbered by doc_id (missing last),
    size and checksum, so repeated rows get neighbouring numbers and any places.  ``grown_shard`` is NULL: under the law
    of rows a further shard moves rows of all shards.
    """
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                              (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharded(narrow, [F.asc_nulls_last("doc_id"), F.col("size"), F.col("text_crc32")], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
