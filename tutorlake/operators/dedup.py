"""Keyed de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F


def first_seen(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """First row of every key in ``seq`` order; copies are dropped before the shuffle."""
    row = F.struct(*[c for c in df.columns if c not in keys])
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*seq)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def only_new(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """First rows whose key the target lacks: what an insert-or-ignore load appends.

    Both sides are merged by key.  Left to an estimate, the keys of a whole log would be broadcast: keys that were read out
    of documents are taken for hundreds of times smaller than they are.  Copies among the changes are gone by then; an anti
    join may be moved before that and be asked with every copy.
    """
    stored = target.select(*keys, F.lit(True).alias("__stored")).hint("merge")
    return first_seen(changes, keys, seq).join(stored, list(keys), "left").filter(F.col("__stored").isNull()).drop("__stored")


def smallest_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, the smallest, so that the choice never varies."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def stream_first(df: DataFrame, key: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Streaming form: one row per key, with bounded state when a watermark is given."""
    if watermark is None:
        return df.dropDuplicates([key])
    return df.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])


#: Groups that a micro-batch's rows are dealt into to find the first copy of each key.
_GROUPS = 1024


def first_ever(df: DataFrame, key: str, seq: str, counts: Column) -> DataFrame:
    """Streaming form over all history: the first row of every key, by ``seq`` within the micro-batch that brings it.

    Each key is an entry of the stream's state store, which is asked for the keys of a micro-batch alone.  Rows for which
    ``counts`` does not hold all pass and leave no state.  Copies inside a micro-batch are reduced to the first before the
    store is asked, so that it never has to choose.
    """
    def firsts(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [(key, "ascending"), (seq, "ascending")]))
        keys = rows.column(key).combine_chunks()
        begins = pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), True)
        return rows.filter(pa.chunked_array([pa.array([True]), begins]))

    counted = F.coalesce(counts, F.lit(False))
    dealt = df.filter(counted).groupBy(F.pmod(F.xxhash64(key), F.lit(_GROUPS)))
    return dealt.applyInArrow(firsts, df.schema).dropDuplicates([key]).unionByName(df.filter(~counted))
