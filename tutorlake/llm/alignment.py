"""Two tokenizers aligned over a corpus whose equal texts are read once.

The documents are shuffled by full text (copies combine before the shuffle, so a text that a third of all rows hold is one
row per map task).  Each distinct text is tokenised and aligned once; what it adds to the corpus counts is weighted by its
number of copies, and its measures are joined to the documents by a 256-bit digest.

Texts are handled in chunks of bounded size.  A chunk keeps the pairs of its texts as places in its own list of distinct
pairs; only that list travels, once to be summed and once to fetch the sums.  A pair that every text holds comes once per
chunk.  No table of pairs is broadcast or collected.

Tokens are laid over the bytes of a blank and the text.  Where tokens of both sides end, a group ends.  Every stretch
between neighbouring ends of any side lies in exactly one token of each side, so stretches are the overlapping pairs.

Defined cases: texts that are NULL or empty, or whose tokens do not join to the blank and the text again, have no tokens
(zeros, empty digest); repeated rows each count as a document; strings of special tokens are plain text; a missing
``doc_id`` stays missing; columns other than ``doc_id`` and ``text`` are never read; an empty table gives an empty result.
A text must fit a Python worker several times over.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import pack_plain, unpack_plain
from tutorlake.session import stored

#: Folder of the vocabulary files, on every executor, and the two files.
FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a chunk; one longer text is a chunk of its own.
CHUNK_BYTES = 16 << 20
#: A pair is one number: the byte token's id, then the piece's id in so many bits.
PIECE_BITS = 15
#: How the byte-level tokenizer splits a text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokenizer:
    """Ids and bytes of the byte-level vocabulary.

    Its merges come in the order of their ids, so that the ids serve as ranks of the faster of two public libraries,
    which gives the same ids.  A text that library refuses (its pattern search has a limit) goes to the other one.
    """

    def __init__(self, path: str):
        import tiktoken
        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {entry["content"] for entry in model["added_tokens"] if entry["special"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special}
        if any(model["model"]["vocab"]["".join(merge)] != 256 + i for i, merge in enumerate(model["model"]["merges"])):
            raise ValueError(f"{path}: ids do not follow the merges")
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def patient(self):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, text: str) -> list[int]:
        try:
            return self.coder.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # a panic of the library is no Exception
            return self.patient.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Ids and bytes of the piece vocabulary, which sets a blank before each text."""

    def __init__(self, path: str):
        import sentencepiece
        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, self.coder.id_to_piece(i)) for i in range(self.coder.vocab_size())]
        if len(pieces) > 1 << PIECE_BITS:
            raise ValueError(f"{path}: more than {1 << PIECE_BITS} pieces")
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                         for i, p in pieces]

    def encode(self, text: str) -> list[int]:
        return self.coder.encode(text)


@functools.cache
def tokenizers(folder: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    """Both tokenizers, read once per worker."""
    return ByteTokenizer(f"{folder}/{BYTE_FILE}"), PieceTokenizer(f"{folder}/{PIECE_FILE}")


@functools.cache
def _decimals(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids, left-aligned in rows with room for a separator, and how many there are."""
    texts = [str(i).encode() for i in range(ids)]
    room = max(map(len, texts)) + 1
    digits = np.frombuffer(b"".join(t.ljust(room, b"\0") for t in texts), np.uint8).reshape(ids, room)
    return digits, np.array([len(t) for t in texts], np.int64)


@dataclass(frozen=True)
class Aligned:
    """One text: token ids, for each side the group of every token, and the pair of every stretch."""
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    pairs: np.ndarray

    @property
    def groups(self) -> int:
        return int(self.group_a[-1]) + 1

    def written(self) -> bytes:
        """``a1,a2|b1;a3|b2,b3``"""
        n_a, n_b = len(self.a), len(self.b)
        per_a, per_b = np.bincount(self.group_a), np.bincount(self.group_b)
        place_a = np.arange(n_a) + (np.cumsum(per_b) - per_b)[self.group_a]
        place_b = np.arange(n_b) + np.cumsum(per_a)[self.group_b]
        ids, marks = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a[np.cumsum(per_a) - 1]] = ord("|")
        marks[place_b[np.cumsum(per_b) - 1]] = ord(";")
        digits, lengths = _decimals(1 << 16)
        rows, width = digits[ids], lengths[ids]
        rows[np.arange(len(ids)), width] = marks
        return rows[np.arange(rows.shape[1]) <= width[:, None]].tobytes()[:-1]


def align(text: str | None, byte_side: ByteTokenizer, piece_side: PieceTokenizer) -> Aligned | None:
    """Both tokenizations of a blank and the text laid over each other; None where a side does not give its bytes again."""
    if not text:
        return None
    whole = " " + text
    a, b = byte_side.encode(whole), piece_side.encode(text)
    bytes_a, bytes_b = [byte_side.bytes_of[i] for i in a], [piece_side.bytes_of[i] for i in b]
    raw = whole.encode("utf-8")
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    ends_a, ends_b = (np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens))) for tokens in (bytes_a, bytes_b))
    last_a, last_b = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
    last_a[ends_a] = last_b[ends_b] = True
    ends = np.flatnonzero(last_a | last_b)
    both = last_a & last_b
    # Tokens before a stretch's end on each side; groups before a token's end.
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    group = np.cumsum(both) - both
    return Aligned(a, b, group[ends_a], group[ends_b], a[at_a] << PIECE_BITS | b[at_b])


_CHUNK = ("chunk long, digests binary, written binary, measures binary, sizes binary, places binary, times binary, "
          "pairs array<int>, weights array<long>")
_CHUNK_KINDS = pa.schema([
    ("chunk", pa.int64()), *[(name, pa.binary()) for name in ("digests", "written", "measures", "sizes", "places", "times")],
    ("pairs", pa.list_(pa.int32())), ("weights", pa.list_(pa.int64()))])
_MEASURES = "digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _chunk(number: int, rows: list[tuple[str, bytes, int]], folder: str) -> pa.RecordBatch:
    """One row for the texts of a chunk: measures, and each text's distinct pairs as places in the chunk's list."""
    sides = tokenizers(folder)
    measures, written, held, times, sizes = [], [], [], [], []
    for text, _, _ in rows:
        found = align(text, *sides)
        if found is None:
            measures.append((0, 0, 0, 0))
            written.append(bytes(32))
            sizes.append(0)
            continue
        measures.append((len(found.a), len(found.b), found.groups, len(found.pairs)))
        written.append(hashlib.sha256(found.written()).digest())
        ordered = np.sort(found.pairs)
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        held.append(ordered[first].astype(np.int32))
        times.append(np.diff(first, append=len(ordered)).astype(np.uint32))
        sizes.append(len(first))
    every = np.concatenate(held) if held else np.empty(0, np.int32)
    pairs, places = np.unique(every, return_inverse=True)
    copies = np.repeat(np.array([n for _, _, n in rows], np.float64), sizes)
    weights = np.bincount(places, weights=copies, minlength=len(pairs)).astype(np.int64)
    row = [number, b"".join(d for _, d, _ in rows), b"".join(written),
           pack_plain(np.array(measures, np.uint64).ravel()), pack_plain(np.array(sizes, np.uint64)),
           pack_plain(places.astype(np.uint64)), pack_plain((np.concatenate(times) if times else np.empty(0)).astype(np.uint64)),
           pairs, weights]
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, _CHUNK_KINDS.types)], schema=_CHUNK_KINDS)


def _measured(chunk: pa.Table, replies: pa.Table) -> pa.Table:
    """The measures of a chunk's texts, once the sums of its pairs are there."""
    (row,) = chunk.to_pylist()
    order = np.argsort(replies.column("pair").to_numpy())
    counts, best = replies.column("n").to_numpy()[order], replies.column("best").to_numpy(zero_copy_only=False)[order]
    sizes, places, times = (unpack_plain(row[name]).astype(np.int64) for name in ("sizes", "places", "times"))
    if len(counts) != len(row["pairs"]):
        raise ValueError("a chunk's pairs and their sums do not match")
    ends = np.concatenate(([0], np.cumsum(sizes)))

    def per_text(values: np.ndarray) -> np.ndarray:
        totals = np.concatenate(([0], np.cumsum(values)))
        return totals[ends[1:]] - totals[ends[:-1]]

    n_a, n_b, n_groups, n_links = unpack_plain(row["measures"]).astype(np.int64).reshape(-1, 4).T
    parts = [[row[name][i:i + 32] for i in range(0, len(row[name]), 32)] for name in ("digests", "written")]
    return pa.table({
        "digest": pa.array(parts[0], pa.binary()), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
        "n_best": per_text(times * best[places]), "count_sum": per_text(times * counts[places]),
        "groups_sha256": pa.array([digest.hex() if n else "" for digest, n in zip(parts[1], n_a)], pa.string())})


@dataclass(frozen=True)
class Alignment:
    """``measures`` by document, and ``pairs``: ``a``, ``b``, ``n`` (documents that hold the pair linked), ``best``."""
    measures: DataFrame
    pairs: DataFrame


def aligned(docs: DataFrame, folder: str = FOLDER) -> Alignment:
    """Align the tokenizations of every text of ``docs`` (``doc_id``, ``text``)."""
    digest = F.unhex(F.sha2("text", 256))
    texts = docs.filter(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, size, rows = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if rows and size + len(row[0]) > CHUNK_BYTES:
                    yield _chunk(part << 24 | count, rows, folder)
                    count, size, rows = count + 1, 0, []
                rows.append(row)
                size += len(row[0])
        if rows:
            yield _chunk(part << 24 | count, rows, folder)

    chunks = stored(texts.select("text", digest.alias("digest"), "copies").mapInArrow(tokenise, _CHUNK), "aligned-chunks")
    added = chunks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("e")).select("e.pairs", "e.weights")
    counts = added.groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", PIECE_BITS)), "aligned-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").withColumn("best", F.col("n") == F.col("most")).drop("most")
    asked = chunks.select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair"))
    replies = asked.join(counts, "pair").select("of", "pair", "n", "best")
    measures = chunks.groupBy("chunk").cogroup(replies.groupBy("of")).applyInArrow(_measured, _MEASURES)
    # The digest stands for the text; documents that share one meet its single row.
    names = [c.strip().split()[0] for c in _MEASURES.split(",")][1:]
    found = docs.select("doc_id", digest.alias("digest")).join(measures, "digest", "left").select("doc_id", *[
        F.coalesce(name, F.lit("") if name == "groups_sha256" else F.lit(0).cast("long")).alias(name) for name in names])
    low = F.col("pair").bitwiseAND(F.lit((1 << PIECE_BITS) - 1))
    return Alignment(found, counts.select("a", low.alias("b"), "n", "best"))


def alignment_measures(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Per document: tokens, groups, links, best links, summed counts and a digest of the groups."""
    return aligned(docs, folder).measures
