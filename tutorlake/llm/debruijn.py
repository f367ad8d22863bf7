"""Substring dedup by compaction of a de Bruijn graph of words.

Nodes are runs of ``WINDOW - 1`` words, edges runs of ``WINDOW`` words.  One packed exchange counts every edge over the
corpus and tells whether its first node has further successors (the end of a document is a successor too).  A node
between two edges of a document does not branch if it has one successor and both edges occur equally often: a second
way in would make the edge after it more frequent.  So each document is cut at branching nodes by what it knows of its own
edges, and what remains between two cuts, a compacted path, lies whole in every document that holds any of its edges.

The occurrences of repeated paths, with their source coordinates, are grouped and joined in Spark: the smallest document
of a path keeps it, provided that first edge (by a second hash), last edge and length agree; all others lose its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm import exchange
from tutorlake.llm.common import mix, scanned, window_hashes, word_hashes, words_of
from tutorlake.session import stored

#: Words of an edge.
WINDOW = 13
#: Low bits of an edge's number that tell a node's successors apart; the bits above are the node's.
NEXT_BITS = 24
_NODE = np.uint64((1 << 64) - (1 << NEXT_BITS))
_END = mix(np.array([1], np.uint64), 999)[0]


def edges(hashes: np.ndarray, window: int) -> np.ndarray:
    """Numbers of a document's edges in order, and last that of its end; empty if it has no node."""
    nodes = window_hashes(hashes, window - 1)
    if not len(nodes):
        return nodes
    following = mix(np.append(hashes[window - 1:], _END), 55)
    return (nodes & _NODE) | (following >> np.uint64(64 - NEXT_BITS))


def _announce(window: int):
    def announce(rows: list[tuple]):
        held = [edges(word_hashes(words_of(row[-1])), window) for row in rows]
        numbers, counts = np.unique(np.concatenate(held), return_counts=True)
        return numbers, counts.astype(np.uint64), None
    return announce


def _degrees(numbers: np.ndarray, owner: np.ndarray, counts: np.ndarray, extra: list) -> np.ndarray:
    """0 for an edge that occurs once, else twice its count, plus 1 if its first node has several successors."""
    distinct, at = np.unique(numbers, return_inverse=True)
    total = np.bincount(at, weights=counts.astype(np.float64)).astype(np.int64)
    nodes = distinct & _NODE
    alone = np.ones(len(nodes), bool)
    same = nodes[1:] == nodes[:-1]
    alone[1:][same] = False
    alone[:-1][same] = False
    return np.where(total > 1, 2 * total + ~alone, 0)[at]


def paths(degrees: np.ndarray) -> list[tuple[int, int]]:
    """(start, edges) of a document's compacted repeated paths, from the answers for its edges."""
    repeated = degrees > 0
    cut = np.ones(len(degrees) + 1, bool)
    if len(degrees):
        cut[1:-1] = (degrees[1:] & 1 == 1) | (degrees[1:] >> 1 != degrees[:-1] >> 1)
    borders = np.flatnonzero(cut)
    return [(int(a), int(b - a)) for a, b in zip(borders[:-1], borders[1:]) if repeated[a]]


_FOUND = ("row long, doc_id long, n_words long, whole string, packed binary, starts array<int>, lengths array<int>, "
          "firsts array<long>, checks array<long>")
_FOUND_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                pa.list_(pa.int64()), pa.list_(pa.int64()))


def _find(window: int):
    def build(chunk: int, rows: list[tuple], answers: np.ndarray) -> pa.Table:
        hashed = [word_hashes(words_of(row[-1])) for row in rows]
        held = [edges(h, window) for h in hashed]
        known = np.unique(np.concatenate(held))
        exchange.expect(answers, known)
        squeeze, out = zstandard.ZstdCompressor(level=3), []
        for i, ((doc_id, text), hashes, numbers) in enumerate(zip(rows, hashed, held)):
            own = numbers[:-1]
            found = paths(answers[np.searchsorted(known, own)].astype(np.int64))
            words = words_of(text)
            plain = b" ".join(words)
            starts = np.array([s for s, _ in found], np.int64)
            lengths = np.array([n for _, n in found], np.int64)
            checks = np.empty(0, np.uint64)
            if found:
                checks = window_hashes(mix(hashes, 77), window)[starts] ^ mix(own[starts + lengths - 1], 33)
            out.append((chunk << 24 | i, doc_id, len(words), None if found else hashlib.sha256(plain).hexdigest(),
                        squeeze.compress(plain) if found else None, starts.tolist(), lengths.tolist(),
                        own[starts].view(np.int64).tolist() if found else [], checks.view(np.int64).tolist()))
        names = [part.split()[0] for part in _FOUND.split(", ")]
        return pa.table({k: pa.array(c, t) for k, t, c in zip(names, _FOUND_KINDS, zip(*out))})
    return build


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _keep(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            for n, whole, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("n_words", "whole", "packed", "spans"))):
                if whole is not None:
                    removed.append(0)
                    digests.append(whole)
                    continue
                words = zstandard.ZstdDecompressor().decompress(packed).split()
                gone = np.zeros(n + 1, np.int64)
                for span in spans or ():
                    gone[span["start"]] += 1
                    gone[span["start"] + span["length"] + window - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()),
                                              pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return keep


def occurrences(documents: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The stored rows with their texts, and the occurrences of repeated paths with ``least``, the smallest doc_id of each."""
    docs = scanned(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                   "graph-docs")
    answers = exchange.answers(docs, _announce(window), _degrees, exchange.range_count(docs))
    found = stored(exchange.with_answers(docs, answers, _find(window), _FOUND), "graph-found")
    each = found.select("row", "doc_id", F.explode(F.arrays_zip("starts", "lengths", "firsts", "checks")).alias("p")).select(
        "row", "doc_id", F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"), F.col("p.firsts").alias("first"),
        F.col("p.checks").alias("check"))
    least = stored(each.groupBy("first", "length", "check").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1"), "graph-paths")
    return found, each.join(least, ["first", "length", "check"])


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every row.

    A word goes if a window of ``window`` words around it also starts in a document with a smaller doc_id.  A missing
    doc_id counts as larger than any other; rows that repeat an id do not remove each other's words.  Missing, empty and
    short texts keep all words.  Other columns are ignored.
    """
    found, each = occurrences(documents, window)
    later = (F.col("least") < F.col("doc_id")) | (F.col("doc_id").isNull() & F.col("least").isNotNull())
    spans = each.filter(later).groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    whole = found.filter("packed IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                                  F.col("whole").alias("kept_sha256"))
    cut = (found.filter("packed IS NOT NULL").join(spans, "row", "left")
           .select("doc_id", "n_words", "whole", "packed", "spans").mapInArrow(_keep(window), _RESULT))
    return whole.union(cut)
