"""Exact top-k search by distributed histogram selection.

Vectors are dealt to blocks, queries to query blocks, and every pair of blocks is scored by one matrix product.  The
score of each query's k-th neighbour is located by global histograms: every tile counts its scores in bins of the
query's current interval, the counts are summed over all tiles, and the bin that holds the k-th becomes the next
interval, until it is one score wide.  A last pass keeps what reaches that score; ties go to smaller ids.

A task holds one tile, some blocks of bounded size, and some query blocks pass it one by one.  So a block is sent once per
group of query blocks and a query block once per tile, both by shuffle, and neither comes to the driver.  A tile counts
its k best scores of a query only: those above the global k-th are fewer than k, so all are among them, and of the scores
that equal it no more than k are asked for.  Of equal scores a tile keeps its k smallest ids, which loses nothing, so a
vector that a third of all rows repeat does not flood the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.session import stored

#: Neighbours; a component counts as floor(SCALE * x); rows of a block at most on average; bins of a histogram.
K, SCALE, BLOCK, BINS = 20, 64.0, 2048, 512
#: Bytes of the vectors that one task holds, and of the queries that pass them; pairs of blocks that one task scores.
TILE_BYTES, PAIRS = 32 << 20, 4096

_BLOCK = "block int, dim int, ids binary, matrix binary"


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id``, ``v`` (array of long) of the vectors whose components are all finite numbers; rows without id are left out."""
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), parts.alias("v"))


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    """Rows packed by a hash of their id and by length; vectors of different length are not compared."""

    def packed(group: pa.Table) -> pa.Table:
        ids = np.array(group.column("vec_id").to_pylist(), np.int64)
        order = np.argsort(ids, kind="stable")
        dim = group.column("dim")[0].as_py()
        flat = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        matrix = flat.reshape(len(ids), dim)[order]
        return pa.table({"block": group.column("block").slice(0, 1), "dim": group.column("dim").slice(0, 1),
                         "ids": pa.array([ids[order].tobytes()], pa.binary()), "matrix": pa.array([_small(matrix)], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")).withColumn("dim", F.size("v"))
    return dealt.groupBy("block", "dim").applyInArrow(packed, _BLOCK)


def _small(matrix: np.ndarray) -> bytes:
    """The numbers in the narrowest whole type, its width first."""
    for kind in (np.int8, np.int16, np.int32):
        if not matrix.size or (matrix.min() >= np.iinfo(kind).min and matrix.max() <= np.iinfo(kind).max):
            return bytes([np.dtype(kind).itemsize]) + matrix.astype(kind).tobytes()
    return bytes([8]) + matrix.tobytes()


def _matrix(blob: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(blob, f"<i{blob[0]}", offset=1).reshape(rows, dim)


def _largest(matrix: np.ndarray) -> float:
    return max(float(matrix.max()), -float(matrix.min())) if matrix.size else 0.0


#: Score of a query with itself, and where a tile has fewer than k.
OWN = np.iinfo(np.int64).min

#: Ids in ascending order, vectors, and the largest size of a component.
_Block = tuple[np.ndarray, np.ndarray, float]


def _scores(queries: _Block, tile: list[_Block]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and exact scores of each block of a tile, a query's own row marked by the lowest number.

    By floating point where it holds every sum as it is, else in whole numbers.
    """
    ids, left, largest = queries
    sums = largest * max((block[2] for block in tile), default=0.0) * max(left.shape[1], 1)
    kind = np.float32 if sums < 1 << 24 else np.float64 if sums < 1 << 53 else np.int64
    left, lowest = left.astype(kind), OWN if kind is np.int64 else -np.inf
    for others, right, _ in tile:
        scores = left @ right.astype(kind).T
        at = np.minimum(np.searchsorted(others, ids), len(others) - 1)
        own = np.flatnonzero(others[at] == ids)
        scores[own, at[own]] = lowest
        yield others, scores


def _places(where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that hold; numpy finds them several times faster in one dimension than in two."""
    return np.divmod(np.flatnonzero(where), where.shape[1])


def _greatest(scores: np.ndarray, k: int) -> np.ndarray:
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def _best(queries: _Block, tile: list[_Block], k: int, low: np.ndarray) -> np.ndarray:
    """The k best scores of each query in a tile, as far as they reach ``low``; the lowest number where there are fewer."""
    best: np.ndarray | None = None
    for _, scores in _scores(queries, tile):
        lowest = scores.dtype.type(OWN if scores.dtype == np.int64 else -np.inf)
        if best is None:
            best = np.full((len(low), k), lowest)
        least = np.maximum(best.min(axis=1), (low - 1).astype(scores.dtype))
        better = scores > least[:, None]
        rows, at = _places(better)
        if len(rows) > 4 * best.size:
            best = _greatest(np.hstack([best, np.where(better, scores, lowest)]), k)
        elif len(rows):
            mine, first, counts = np.unique(rows, return_index=True, return_counts=True)
            found = np.full((len(mine), counts.max()), lowest)
            found[np.repeat(np.arange(len(mine)), counts), np.arange(len(rows)) - np.repeat(first, counts)] = scores[rows, at]
            best[mine] = _greatest(np.hstack([best[mine], found]), k)
    return best


def _nearest(queries: _Block, tile: list[_Block], k: int, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, ids and scores of the k best of a tile that reach ``low``, of equal scores the smallest ids."""
    kept, least = [np.empty(0, np.int64)] * 3, np.maximum(low, OWN + 1)
    for others, scores in _scores(queries, tile):
        reach = scores >= least.astype(scores.dtype)[:, None]
        rows, at = _places(reach)
        if not len(rows):
            continue
        many = np.flatnonzero(np.bincount(rows) > k)
        for i in many.tolist():
            found = np.flatnonzero(reach[i])  # ids ascend, so a stable order by score keeps the smallest of equals
            reach[i] = False
            reach[i, found[np.argsort(-scores[i, found], kind="stable")[:k]]] = True
        if len(many):
            rows, at = _places(reach)
        kept = [np.concatenate(pair) for pair in zip(kept, (rows, others[at], scores[rows, at].astype(np.int64)))]
        order = np.lexsort((kept[1], -kept[2], kept[0]))
        rows = kept[0][order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = [column[order[place < k]] for column in kept]
        full = place == k - 1
        least[rows[full]] = np.maximum(least[rows[full]], kept[2][np.flatnonzero(place[place < k] == k - 1)])
    return kept[0], kept[1], kept[2]


def _passing(each: Callable[[dict, _Block, list[_Block]], pa.RecordBatch | None]):
    """Rows of tasks as ``pairs`` deals them: the blocks of a task's tile, then its query blocks, each of which meets the tile."""
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, tile = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["task"], row["dim"]) != here:
                    here, tile = (row["task"], row["dim"]), []
                ids = np.frombuffer(row["ids"], "<i8")
                matrix = _matrix(row["matrix"], row["dim"], len(ids))
                block = (ids, matrix, _largest(matrix))
                if row["low"] is None:
                    tile.append(block)
                elif tile and (found := each(row, block, tile)) is not None:
                    yield found
    return passing


_COUNTS = "q_block int, dim int, places binary, bins binary, ns binary"


def _count(k: int):
    def count(row: dict, queries: _Block, tile: list[_Block]) -> pa.RecordBatch | None:
        low, width, need = (np.frombuffer(row[c], "<i8") for c in ("low", "width", "need"))
        asked = np.flatnonzero(need > 0)
        if not len(asked):
            return None
        low, width = low[asked, None], width[asked, None]
        best = _best((queries[0][asked], queries[1][asked], queries[2]), tile, k, low[:, 0])
        rows, at = np.nonzero(best >= low.astype(best.dtype))
        # Scores above the interval were counted in an earlier round.
        cell = (best[rows, at].astype(np.int64) - low[rows, 0]) // width[rows, 0]
        inside = cell < BINS
        found, n = np.unique(asked[rows[inside]] * BINS + cell[inside], return_counts=True)
        columns = [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (found // BINS, found % BINS, n)]
        return pa.RecordBatch.from_arrays(
            [pa.array([row["block"]], pa.int32()), pa.array([row["dim"]], pa.int32()), *columns], ["q_block", "dim", "places", "bins", "ns"])
    return _passing(count)


_STATE = "q_block int, dim int, q_ids binary, q_matrix binary, low binary, width binary, need binary"
_STATE_KINDS = pa.schema([("q_block", pa.int32()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("q_ids", "q_matrix", "low", "width", "need"))])


def _refine(states: pa.Table, counts: pa.Table) -> pa.Table:
    """The next interval of each query: the bin in which the count from above reaches what is needed."""
    row = states.to_pylist()[0]
    low, width, need = (np.frombuffer(row[c], "<i8").copy() for c in ("low", "width", "need"))
    places, bins, ns = (np.frombuffer(b"".join(counts.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("places", "bins", "ns"))
    cells, at = np.unique(places * BINS + (BINS - 1 - bins), return_inverse=True)  # by place, the highest bin first
    places, bins, ns = cells // BINS, BINS - 1 - cells % BINS, np.bincount(at, ns, len(cells)).astype(np.int64)
    starts = np.searchsorted(places, np.arange(len(low) + 1))
    for i in np.flatnonzero(need > 0).tolist():
        own = slice(starts[i], starts[i + 1])
        above = np.cumsum(ns[own])
        hit = int(np.searchsorted(above, need[i]))
        if hit == len(above):  # fewer candidates than asked for: all are taken
            low[i], width[i], need[i] = OWN + 1, 1, 0
            continue
        need[i] -= above[hit - 1] if hit else 0
        low[i] += int(bins[own][hit]) * int(width[i])
        if width[i] == 1:
            need[i] = 0
        width[i] = max(1, int(width[i]) // BINS)
    return pa.Table.from_pylist([{**row, "low": low.tobytes(), "width": width.tobytes(), "need": need.tobytes()}], _STATE_KINDS)


_HITS = "query_id long, vec_id long, score long"


def _collect(k: int):
    def collect(row: dict, queries: _Block, tile: list[_Block]) -> pa.RecordBatch | None:
        rows, ids, scores = _nearest(queries, tile, k, np.frombuffer(row["low"], "<i8"))
        if not len(rows):
            return None
        return pa.RecordBatch.from_arrays([pa.array(queries[0][rows]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])
    return _passing(collect)


def _dealing(blocks: int, q_blocks: int, tasks: int, least_tiles: int, least_groups: int) -> tuple[int, int]:
    """Numbers of tiles and of groups of query blocks, for about so many tasks and with the fewest bytes sent."""
    groups = min(q_blocks, max(least_groups, round(math.sqrt(tasks * q_blocks / blocks))))
    return min(blocks, max(least_tiles, -(-tasks // groups))), groups


def nearest(vectors: DataFrame, is_query, k: int = K, scale: float = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best candidates of every query row.

    Vectors that are missing or hold a missing or non-finite component take no part, nor do rows without id; vectors of
    unlike length are not compared; empty vectors score 0.  Of repeated rows of one id one takes part.  Fewer candidates
    than k are all returned.  Scores must fit 64 bits.  ``is_query`` is a condition on ``vec_id``.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, scale).groupBy("vec_id").agg(F.min("v").alias("v")), "topk-rows")
    total, asked = (max(1, n or 0) for n in rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first())
    blocks, q_blocks = -(-total // BLOCK), -(-asked // BLOCK)
    others = stored(_blocks(rows, blocks), "topk-blocks")
    peak = rows.agg(F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))), F.max(F.size("v"))).first()
    bound = min(int(peak[0] or 0) ** 2 * int(peak[1] or 1), (1 << 62) - 1)
    first_width = 1  # a power of BINS, so that each bin is divided without remainder
    while first_width * BINS < 2 * bound + 1:
        first_width *= BINS

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                n = len(row["ids"]) // 8
                rows.append({"q_block": row["block"], "dim": row["dim"], "q_ids": row["ids"], "q_matrix": row["matrix"],
                             "low": np.full(n, -bound, "<i8").tobytes(), "width": np.full(n, first_width, "<i8").tobytes(),
                             "need": np.full(n, k, "<i8").tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _STATE_KINDS)

    state = stored(_blocks(rows.filter(is_query), q_blocks).mapInArrow(begin, _STATE), "topk-state-0")

    held = int(peak[1] or 1) * next(n for n in (1, 2, 4, 8) if n == 8 or int(peak[0] or 0) < 1 << (8 * n - 1)) + 8
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks * q_blocks // PAIRS))
    tiles, groups = _dealing(blocks, q_blocks, tasks, -(-total * held // TILE_BYTES), -(-asked * (held + 24) // TILE_BYTES))

    def pairs(state: DataFrame) -> DataFrame:
        """Every block with every query block: the rows of each task, its tile before the query blocks that pass it."""
        none = F.lit(None).cast("binary")
        tile, group = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))), F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        left = others.select(F.col("block") % tiles, group, "dim", "block", "ids", "matrix", none, none, none)
        right = state.select(tile, F.col("q_block") % groups, "dim", "q_block", "q_ids", "q_matrix", "low", "width", "need")
        rows = left.union(right).toDF("tile", "group", "dim", "block", "ids", "matrix", "low", "width", "need")
        rows = rows.withColumn("task", F.col("tile") * groups + F.col("group")).drop("tile", "group")
        return rows.repartitionById(tiles * groups, "task").sortWithinPartitions("task", "dim", F.col("low").isNotNull())

    step, width = 0, first_width
    while True:
        step += 1
        counts = pairs(state).mapInArrow(_count(k), _COUNTS)
        state = stored(state.groupBy("q_block", "dim").cogroup(counts.groupBy("q_block", "dim")).applyInArrow(_refine, _STATE),
                       f"topk-state-{step}")
        if width == 1:
            break
        width = max(1, width // BINS)
    hits = pairs(state).mapInArrow(_collect(k), _HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
