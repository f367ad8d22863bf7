"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words.  All documents of a source have the same expected number of copies, target over
size of the source.  Its whole part is given to every document; its fraction is the inclusion probability of one more
copy.  For that copy documents are ranked by random odds divided by inclusion odds, and the sample is the head of that
ranking whose words come nearest to what is left of the target.  The heads are found with running sums over ranges of
(source, rank), so no source, however large, meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.llm.common import numbered, unused, with_row, word_count
from tutorlake.session import stored

#: Weights of the sources in order, repeating; words of the mix over words of the input; copies of a document at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` of the sources of ``source``/``size`` rows.

    Sources by code point, NULL last, take the weights in turn.  A target above ``most`` times its source is cut there
    and the excess is dealt to the others by weight, until none is above: target = min(most * size, level * weight).
    Only the level, one number a round, is on the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, [F.asc_nulls_last("source")], "place", "mix-sources")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(ranked.select("source", "source_size", F.get(turn, F.col("place") % len(weights)).alias("weight"),
                                  (F.col("source_size") * float(most)).alias("cap")), "mix-weights")
    first = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    wanted = share * (first["words"] or 0)
    level, stopped = (wanted / first["weight"] if first["weight"] else 0.0), 0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum(F.when(full, F.col("cap"))).alias("cut"), F.count(F.when(full, 1)).alias("n"),
                         F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if row["n"] == stopped or not row["weight"]:
            break
        stopped, level = row["n"], max(level, (wanted - (row["cut"] or 0)) / row["weight"])
    return ranked.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def uniform(seed: int, *columns: str) -> Column:
    """A reproducible number inside (0, 1)."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def mixed(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
          seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies`` and ``source``, one row per input row.

    Documents without words (missing, empty or blank text) have size 0, are never taken and have 0 copies.  A missing
    source is a source of its own; a missing doc_id ranks like any other value.  Repeated rows share their random
    number and are ranked next to each other.  Other columns are ignored, but for those named in ``keep``, which follow and
    decide ties of the ranking; their names must not clash with those of the result.
    """
    sizes = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                    word_count("text").alias("size"), *keep), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # The margin keeps a ratio that is whole but for rounding from leaving a stray fraction.
    known = (targets.withColumn("whole", F.floor(ratio + 1e-9))
             .withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
             .withColumn("chance", F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), ratio - F.col("whole"))))
             .withColumnRenamed("source", "of"))
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    u = uniform(seed, "doc_id")
    odds = F.col("chance") / (1 - F.col("chance"))
    rows = rows.withColumn("rank", u / (1 - u) / odds)
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_last("source"), F.col("rank"), F.asc_nulls_last("doc_id"), F.col("size"), *keep]
    dealt = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "mix-ranks")
    inside = Window.partitionBy("part", "source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (dealt.groupBy("source", "part").agg(F.sum("size").alias("words"))
            .select(F.col("source").alias("s"), F.col("part").alias("p"),
                    F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")))
    placed = dealt.join(sums, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    # A document belongs to the head if at least half of its words do.
    middle = F.col("offset") + F.col("before") + F.col("size") / 2
    copies = F.when(F.col("size") > 0, F.col("whole") + F.when(middle <= F.col("left"), 1).otherwise(0)).otherwise(F.lit(0))
    return placed.withColumn("copies", copies.cast("long")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", *keep)


def take(documents: DataFrame, copies: DataFrame) -> DataFrame:
    """The documents as often as ``doc_id``/``copies`` says; of an id's several numbers the largest counts."""
    names = documents.columns
    key, number, each = (unused(documents, name) for name in ("_id", "_copies", "_copy"))
    wanted = copies.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(number)).filter(F.col(number) > 0)
    return (documents.join(wanted, F.col("doc_id").eqNullSafe(F.col(key)))
            .withColumn(each, F.explode(F.sequence(F.lit(1).cast("long"), F.col(number)))).select(*names))


def take_rows(documents: DataFrame) -> DataFrame:
    """Every row as often as ``mixed`` says of that row, whatever its id."""
    rows, row = with_row(documents, "mix-rows")
    number, each = (unused(rows, name) for name in ("_copies", "_copy"))
    wanted = mixed(rows, keep=[row]).filter("copies > 0").select(row, F.col("copies").alias(number))
    return (rows.join(wanted, row)
            .withColumn(each, F.explode(F.sequence(F.lit(1).cast("long"), F.col(number)))).select(*documents.columns))
