"""Suffix-array dedup of byte strings, block by block, with a difference cover.

A difference cover modulo V is a small set of residues such that any two positions reach positions of the set by one
common step below V.  So two equal strings of LENGTH bytes, wherever they start, share a covered position inside, and
from there LENGTH - V + 1 equal bytes: the prefix that names a covered suffix.  First the names of the covered suffixes
(one position in thirteen) are ranked over the corpus as repeated or single.  Then only suffixes whose reach holds a repeated name
take part: their blocks, ranges of the fingerprint of LENGTH bytes, are sorted one at a time, and equal neighbours are repeated
strings.  A suffix that ties with others for longer than a name is thus settled by the ranks of the cover, and neither
texts nor suffix lists are ever sorted as a whole.  Only equality matters here, so blocks are ordered by fingerprints of
64 bits, not by bytes.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm import exchange
from tutorlake.llm.common import mix, scanned
from tutorlake.session import stored

#: Bytes of a repeated string.
LENGTH = 400
#: A prime; the cover has ORDER + 1 residues modulo ORDER ** 2 + ORDER + 1.
ORDER = 13
#: Leading bits of a name that are sent; a collision only lets more suffixes take part.
NAME_BITS = 48
#: Starts that are hashed in one step.
SEGMENT = 1 << 16
_LATER = 1_000_000


@lru_cache
def difference_cover(order: int) -> tuple[int, np.ndarray]:
    """A modulus and its perfect difference set: the zeros of a linear recurrence of full period over a prime field."""
    modulus = order * order + order + 1
    for a, b, c in product(range(order), range(order), range(1, order)):
        x, y, z = 0, 0, 1
        zeros = set()
        for i in range(modulus):
            if x == 0:
                zeros.add(i)
            x, y, z = y, z, (a * z + b * y + c * x) % order
        if len(zeros) == order + 1 and len({(p - q) % modulus for p in zeros for q in zeros}) == modulus:
            return modulus, np.array(sorted(zeros))
    raise ValueError(f"{order} is not prime")


_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 4242)


@lru_cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def fingerprints(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """64-bit fingerprints of the ``length`` bytes at each of the ascending starts."""
    out = np.empty(len(starts), np.uint64)
    for low in range(0, len(raw), SEGMENT):
        a, b = np.searchsorted(starts, (low, low + SEGMENT))
        if a == b:
            continue
        piece = raw[low:low + SEGMENT + length]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * _powers(_STEP, SEGMENT + length)[:len(piece)], out=sums[1:])
        at = starts[a:b] - low
        out[a:b] = (sums[at + length] - sums[at]) * _powers(_BACK, SEGMENT)[at]
    return mix(out, length)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


class Cover:
    """Covered starts of a text and the suffixes that their ranks leave open."""

    def __init__(self, length: int, order: int) -> None:
        self.length = length
        self.modulus, self.residues = difference_cover(order)
        self.name = length - self.modulus + 1
        if self.name < 1:
            raise ValueError("the cover reaches beyond the strings")

    def starts(self, size: int) -> np.ndarray:
        if size < self.length:
            return np.empty(0, np.int64)
        every = (np.arange(0, size, self.modulus)[:, None] + self.residues[None, :]).ravel()
        return every[every <= size - self.name]

    def names(self, raw: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - NAME_BITS)
        return fingerprints(raw, self.starts(len(raw)), self.name) >> shift << shift

    def open_suffixes(self, size: int, repeated: np.ndarray) -> np.ndarray:
        """Starts of strings that reach a covered start with a repeated name."""
        if not repeated.any():
            return np.empty(0, np.int64)
        hits = self.starts(size)[repeated]
        change = np.zeros(size + 2, np.int32)
        np.add.at(change, np.maximum(hits - self.modulus + 1, 0), 1)
        np.add.at(change, hits + 1, -1)
        return np.flatnonzero(np.cumsum(change[:max(0, size - self.length + 1)]) > 0)


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, None]:
    numbers, counts = np.unique(np.concatenate(held), return_counts=True)
    return numbers, np.minimum(counts, 2).astype(np.uint64), None


def _placed(held: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct numbers, ascending, and for each array the places of its numbers among them.

    One sort gives both; ``np.unique`` hashes the numbers and a search for each is a walk through memory, which cost many times it.
    """
    every = np.concatenate(held)
    order = np.argsort(every)
    ordered, first = every[order], np.ones(len(every), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    places = np.empty(len(every), np.int64)
    places[order] = np.cumsum(first) - 1
    return ordered[first], np.split(places, np.cumsum([len(x) for x in held])[:-1])


def _repeated(numbers: np.ndarray, owner: np.ndarray, counts: np.ndarray, extra: list) -> np.ndarray:
    """Sorts one block: 1 for a number that occurs more than once."""
    order = np.argsort(numbers)
    ordered = numbers[order]
    same = np.concatenate(([False], ordered[1:] == ordered[:-1]))
    out = np.empty(len(numbers), bool)
    out[order] = same | np.append(same[1:], False)
    return out | (counts > 1)


def _open(cover: Cover, rows: list[tuple], flags: np.ndarray):
    """Per text its bytes, the starts still open and their fingerprints; and the answers that are left over."""
    raws = [_bytes(row[-1]) for row in rows]
    names = [cover.names(raw) for raw in raws]
    known, places = _placed(names)
    repeated = flags[:len(known)] > 0
    starts = [cover.open_suffixes(len(raw), repeated[own]) for raw, own in zip(raws, places)]
    return raws, starts, [fingerprints(r, s, cover.length) for r, s in zip(raws, starts)], flags[len(known):]


def without_repeated_bytes(documents: DataFrame, length: int = LENGTH, order: int = ORDER) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row.

    Every byte goes that lies in a string of ``length`` bytes which also starts anywhere else, in the same text too;
    no occurrence is kept.  Missing, empty and shorter texts keep all bytes.  A missing doc_id is reported as such, a
    repeated row is one more text.  Other columns are ignored.
    """
    docs = scanned(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                   "suffix-docs")
    cover, buckets = Cover(length, order), exchange.range_count(docs)

    def announce(rows: list[tuple]):
        return _counted([cover.names(_bytes(row[-1])) for row in rows])

    ranks = stored(exchange.answers(docs, announce, _repeated, buckets), "suffix-ranks")

    def sorted_blocks(chunk: int, rows: list[tuple], flags: np.ndarray) -> pa.Table:
        _, _, prints, _ = _open(cover, rows, flags)
        return pa.Table.from_batches(exchange.rows_of(chunk, *_counted(prints), buckets), exchange.SENT_KINDS)

    blocks = exchange.answered(exchange.with_answers(docs, ranks, sorted_blocks, exchange.SENT), _repeated)
    answers = ranks.union(blocks.withColumn("bucket", F.col("bucket") + _LATER))

    def cut(chunk: int, rows: list[tuple], flags: np.ndarray) -> pa.Table:
        raws, starts, prints, later = _open(cover, rows, flags)
        (known, places), out = _placed(prints), []
        exchange.expect(later, known)
        for (doc_id, _), raw, at, own in zip(rows, raws, starts, places):
            hits = at[later[own] > 0]
            change = np.zeros(len(raw) + 1, np.int32)
            change[hits] += 1
            change[hits + length] -= 1
            gone = np.cumsum(change[:-1]) > 0
            spans = np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)
            out.append((doc_id, len(raw), int(np.count_nonzero(gone)), int(spans), hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
        kinds = (pa.int64(),) * 4 + (pa.string(),)
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        return pa.table({k: pa.array(c, t) for k, t, c in zip(names, kinds, zip(*out))})

    return exchange.with_answers(docs, answers, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
