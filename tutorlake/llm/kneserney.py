"""Interpolated modified Kneser-Ney language model, counted in Spark and memory-mapped by the scoring tasks.

Training: the words of all training texts are counted by ranges of their hash; a word's place in the sorted arrays is its
number.  A second reading turns texts into numbers and ships each chunk's distinct n-grams, once and packed, to the range
of the n-gram's hash.  The task of a range adds the chunks' counts up, writes its part of the model, and passes on what the
next lower order needs: how its n-grams continue their first words, and one left neighbour for their last words.  All of
these are sums, so a context that a third of all words follow spreads over all ranges, and no task holds it.

Model: per order and range one file of sorted hashes with, for each, a code into the table of distinct values (count, and as
a context: total, and how many words follow once, twice, more often).  A file is written beside its place and renamed, so
that a task that runs again leaves the same file.  The folder is a new one below the shared folder of the cluster, which
all executors must have mounted: memory-mapping needs files.  Nothing of the model passes through the driver but sums.

Scoring: a task looks up the sorted distinct hashes of a chunk, file by file; each file is mapped while it is read, so that
pages of the shared cache serve all workers and a worker holds no more than its chunk.

Defined cases: NULL and empty texts are one token, the end; a row without ``doc_id`` is learned from and not held out;
repeated rows count each time; an empty training set leaves the uniform model over the unknown word; other columns are never
read.  Words are 64-bit hashes and n-grams those of their numbers, of which ``SUB + 32`` bits beyond the range are kept;
results are exact but for their collisions.  A text must fit a Python worker several times over.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import mix, pack, pack_plain, unpack, unpack_plain, word_hashes
from tutorlake.session import scratch_path

#: Words of the longest n-gram.  Three fit neither the disk nor the seconds that the check tool allows; see README.
ORDER = 2
#: Text bytes of a chunk; one longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Numbers of the marks before a text, after it, and of unknown words; words follow.
BEGIN, END, UNKNOWN, FIRST = 0, 1, 2, 3
#: Bits of a hash that find the stretch of a file in which its 32 kept bits are searched.
SUB = 8
#: Values of an n-gram: its count (or number of left neighbours); as a context the sum of what follows, and how many
#: words follow once, twice, more often.
VALUES = 5
#: Discounts where the counts of counts do not define them.
DEFAULT_DISCOUNTS = (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Model:
    """Where the files are, and the few numbers that belong to all of them."""
    folder: str
    order: int
    bits: int
    starts: tuple[int, ...]
    tokens: int
    types: int
    texts: int
    discounts: tuple[tuple[float, float, float], ...]
    total: tuple[int, int, int, int]

    def word_file(self, part: int) -> str:
        return f"{self.folder}/words/{part:08x}"


# Chunks of texts ----------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of this task in chunks of bounded size; the text is the last column."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            length = len(row[-1] or "")
            if rows and size + length > CHUNK_BYTES:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += length
    if rows:
        yield rows


def _words(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the words of all texts as places in them, and the words of each text.

    ``bytes.lower`` changes A to Z alone, and ``bytes.split`` cuts at the blanks and control characters 9 to 13.
    """
    place: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    parts, lengths = [], []
    for text in texts:
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        parts.append(np.fromiter(map(place.__getitem__, found), np.int64, len(found)))
        lengths.append(len(found))
    return word_hashes(list(place)), np.concatenate(parts), np.array(lengths, np.int64)


def _part_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _by_part(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Ranges that ascending hashes fall into, and where."""
    if not len(hashes):
        return
    parts = _part_of(hashes, bits)
    first = np.flatnonzero(np.diff(parts, prepend=-1))
    for begin, end in zip(first, np.append(first[1:], len(parts))):
        yield int(parts[begin]), slice(int(begin), int(end))


def _first_of_runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows of ascending columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = columns[0][1:] != columns[0][:-1]
        for column in columns[1:]:
            new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _summed(columns: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows in ascending order and the sums of their values."""
    order = np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = _first_of_runs(columns)
    return [c[first] for c in columns], [np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in ascending order and how often each occurs."""
    if len(columns) == 1:
        columns = [np.sort(columns[0])]
    else:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
    first = _first_of_runs(columns)
    return [c[first] for c in columns], np.diff(first, append=len(columns[0]))


# Messages -----------------------------------------------------------------------

_SENT = "part int, body binary"
_SENT_KINDS = pa.schema([("part", pa.int32()), ("body", pa.binary())])


def _sent(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      schema=_SENT_KINDS)


def _seal(columns: list[np.ndarray]) -> bytes:
    """Columns of one length, the first of them ascending, as one packed message."""
    parts = [pack(columns[0]), *map(pack_plain, columns[1:])]
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unseal(body: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(body, "<u4", 1)[0])
    lengths, at, columns = np.frombuffer(body, "<u4", count, 4), 4 + 4 * count, []
    for i, length in enumerate(lengths.tolist()):
        columns.append((unpack_plain if i else unpack)(body[at:at + length]))
        at += length
    return columns


def gram_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams, given as columns of two numbers each."""
    total = np.zeros(len(columns[0]), np.uint64)
    for i, column in enumerate(columns):
        total = mix(total + column, salt=i + 1)
    return total


def _messages(columns: list[np.ndarray], values: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """Distinct ascending n-grams with their values, one message for each range of their hash."""
    parts = (gram_hashes(columns) >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(parts, kind="stable")
    parts, columns, values = parts[order], [c[order] for c in columns], [v[order].astype(np.uint64) for v in values]
    first = np.flatnonzero(np.diff(parts.astype(np.int64), prepend=-1))
    for begin, end in zip(first, np.append(first[1:], len(parts))):
        yield int(parts[begin]), _seal([x[begin:end] for x in (*columns, *values)])


# Files --------------------------------------------------------------------------


def _write(path: str, arrays: list[np.ndarray]) -> None:
    """Arrays behind each other, each at a multiple of 8 bytes; the file appears whole or not at all."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as file:
        for array in arrays:
            file.write(np.array([len(array), array.itemsize], "<i8").tobytes())
            file.write(np.ascontiguousarray(array).tobytes())
            file.write(bytes(-array.nbytes % 8))
    os.replace(draft, path)


def _mapped(path: str) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped; a range without entries has no file."""
    if not os.path.exists(path):
        return []
    raw, at, arrays = np.memmap(path, np.uint8, "r"), 0, []
    while at < len(raw):
        length, width = raw[at:at + 16].view("<i8").tolist()
        arrays.append(raw[at + 16:at + 16 + length * width].view(f"<u{width}"))
        at += 16 + length * width + (-length * width % 8)
    return arrays


def _least_kind(most: int) -> type:
    return next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(kind).max)


def _kept_bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretch of a file, and the 32 bits kept there."""
    below = np.uint64(64 - bits - SUB)
    return ((hashes >> below) & np.uint64((1 << SUB) - 1)).astype(np.int64), (
        (hashes >> (below - np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _write_grams(path: str, columns: list[np.ndarray], values: list[np.ndarray], bits: int) -> None:
    """The n-grams of one range and their values; values of few distinct rows are stored as codes."""
    hashes = gram_hashes(columns)
    order = np.argsort(hashes)
    sub, keys = _kept_bits(hashes[order], bits)
    starts = np.searchsorted(sub, np.arange((1 << SUB) + 1)).astype(np.uint64)
    # Rows become codes column by column: the code so far and the next value make the next code.
    codes, table = np.zeros(len(hashes), np.int64), [np.zeros(1, np.int64)]
    for value in values:
        width = int(value.max()) + 1 if len(value) else 1
        distinct, codes = np.unique(codes * width + value, return_inverse=True)
        table = [t[distinct // width] for t in table] + [distinct % width]
    table = np.stack(table[1:] + [np.zeros_like(table[0])] * (VALUES - len(values)), axis=1)
    _write(path, [starts, table.astype(np.uint64).ravel(), codes[order].astype(_least_kind(len(table))), keys])


def _look_up(folder: str, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Values (rows by ``VALUES``) of ascending hashes; zeros where the model has none."""
    found = np.zeros((len(hashes), VALUES), np.int64)
    for part, span in _by_part(hashes, bits):
        arrays = _mapped(f"{folder}/{part:08x}")
        if not arrays:
            continue
        starts, table, codes, keys = arrays
        table = np.concatenate((np.zeros((1, VALUES), np.int64), table.astype(np.int64).reshape(-1, VALUES)))
        sub, wanted = _kept_bits(hashes[span], bits)
        cut = np.searchsorted(sub, np.arange((1 << SUB) + 1))
        code = np.zeros(len(wanted), np.int64)
        for s in np.flatnonzero(np.diff(cut)):
            own, some = keys[int(starts[s]):int(starts[s + 1])], slice(cut[s], cut[s + 1])
            if len(own):
                at = np.minimum(np.searchsorted(own, wanted[some]), len(own) - 1)
                hit = own[at] == wanted[some]
                code[some] = np.where(hit, codes[int(starts[s]):int(starts[s + 1])][at].astype(np.int64) + 1, 0)
        found[span] = table[code]
    return found


# Words --------------------------------------------------------------------------


def _count_words(texts: DataFrame, folder: str, bits: int) -> list[tuple[int, int, int]]:
    """Write the sorted words of all texts; (range, words, tokens) of every range."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            hashes, places, _ = _words(row[-1] for row in rows)
            if len(hashes):
                (ordered,), (counts,) = _summed([hashes], [np.bincount(places, minlength=len(hashes))])
                yield _sent([(part, _seal([ordered[span], counts[span].astype(np.uint64)]))
                             for part, span in _by_part(ordered, bits)])

    def merge(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        bodies = [_unseal(body) for body in group.column("body").to_pylist()]
        (hashes,), (counts,) = _summed([np.concatenate([b[0] for b in bodies])], [np.concatenate([b[1] for b in bodies])])
        _write(f"{folder}/words/{part:08x}", [hashes, counts.astype(_least_kind(int(counts.max())))])
        return pa.table({"part": pa.array([part], pa.int32()), "words": [len(hashes)], "tokens": [int(counts.sum())]})

    sent = texts.select("text").mapInArrow(send, _SENT)
    ranges = sent.groupBy("part").applyInArrow(merge, "part int, words long, tokens long")
    return sorted(tuple(row) for row in ranges.collect())


def _numbered(model_folder: str, starts: tuple[int, ...], bits: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and training count of every word; ``UNKNOWN`` and 0 for those not trained."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    numbers, counts = np.full(len(hashes), UNKNOWN, np.uint64), np.zeros(len(hashes), np.int64)
    for part, span in _by_part(ordered, bits):
        arrays = _mapped(f"{model_folder}/words/{part:08x}")
        if arrays:
            known, known_counts = arrays
            at = np.minimum(np.searchsorted(known, ordered[span]), len(known) - 1)
            hit = known[at] == ordered[span]
            numbers[order[span]] = np.where(hit, at.astype(np.uint64) + np.uint64(FIRST + starts[part]), np.uint64(UNKNOWN))
            counts[order[span]] = np.where(hit, known_counts[at].astype(np.int64), 0)
    return numbers, counts


def _lines(words: np.ndarray, lengths: np.ndarray, order: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind each other, each after ``order - 1`` marks and before one; and where a token is to be told."""
    pad = order - 1
    ends = np.cumsum(lengths + pad + 1)
    line = np.full(int(ends[-1]) if len(ends) else 0, begin, words.dtype)
    told = np.ones(len(line), bool)
    begins = ends - lengths - pad - 1
    for i in range(pad):
        told[begins + i] = False
    line[ends - 1] = end
    word = told.copy()
    word[ends - 1] = False
    line[word] = words
    return line, told


def _grams(line: np.ndarray, ends: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-grams that end at some places, two numbers to a column."""
    places = [line[ends - (order - 1 - i)].astype(np.uint64) for i in range(order)]
    return [places[i] << np.uint64(32) | places[i + 1] if i + 1 < order else places[i] for i in range(0, order, 2)]


def _shorter(columns: list[np.ndarray], order: int, begin: int) -> list[np.ndarray]:
    """N-grams without their last word (``begin`` 0) or their first (1)."""
    low = np.uint64(0xFFFFFFFF)
    places = [x for i, c in enumerate(columns) for x in ((c >> np.uint64(32), c & low) if 2 * i + 1 < order else (c,))]
    places = places[begin:begin + order - 1]
    return [places[i] << np.uint64(32) | places[i + 1] if i + 1 < len(places) else places[i] for i in range(0, len(places), 2)]


# Training -----------------------------------------------------------------------


def _merged(order: int, folder: str, bits: int):
    """The task of a range of one order: sum, write, pass on to the next lower order.  Sums of all ranges come as ``-order``."""

    def merge(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        bodies = group.column("body").to_pylist()
        if part < 0:
            sums = np.sum([np.frombuffer(body, "<i8") for body in bodies], axis=0)
            return pa.Table.from_batches([_sent([(part, sums.astype("<i8").tobytes())])])
        columns = [np.concatenate(c) for c in zip(*map(_unseal, bodies))]
        width = (order + 1) // 2
        grams, values = _summed(columns[:width], [c.astype(np.int64) for c in columns[width:]])
        del columns, bodies
        _write_grams(f"{folder}/{order}/{part:08x}", grams, values, bits)
        n = values[0]
        # Counts of counts, and what the words of the empty context add up to.
        sums = [int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)] + [int(n.sum()), int(np.count_nonzero(n > 2))]
        out = [(-order, np.array(sums, "<i8").tobytes())]
        if order > 1:
            real = n > 0
            grams, n = [c[real] for c in grams], n[real]
            # N-grams ascend, so those with one context stand together.
            contexts = _shorter(grams, order, 0)
            first = _first_of_runs(contexts)
            follow = [np.add.reduceat(x, first) if len(first) else n for x in (n, *((n == k).astype(np.int64) for k in (1, 2)), (n > 2).astype(np.int64))]
            ends, lefts = _counted(_shorter(grams, order, 1))
            lower = [np.concatenate((c[first], e)) for c, e in zip(contexts, ends)]
            none, blank = np.zeros(len(first), np.int64), np.zeros(len(lefts), np.int64)
            out += _messages(*_summed(lower, [np.concatenate((none, lefts)), *(np.concatenate((f, blank)) for f in follow)]), bits)
        return pa.Table.from_batches([_sent(out)])

    return merge


def _discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many n-grams occur once to four times.

    Corpora full of copies have odd counts of counts; a discount that would take nothing, or more than there is, would leave
    unseen words without probability, and is replaced by its default.
    """
    counts, found = (ones, twos, threes, fours), []
    share = ones / (ones + 2 * twos) if ones else 0.0
    for k in (1, 2, 3):
        value = k - (k + 1) * share * counts[k] / counts[k - 1] if counts[k - 1] else 0.0
        found.append(value if 0 < value < k else DEFAULT_DISCOUNTS[k - 1])
    return tuple(found)


def model_folder(path: str) -> str:
    """The path of a mounted folder; files elsewhere cannot be mapped."""
    plain = path.removeprefix("file://").removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"the model is memory-mapped: {path} must be a folder that all executors have mounted")
    return plain


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """The model of all texts of the column ``text``."""
    spark = texts.sparkSession
    folder = model_folder(scratch_path(spark, "language-model"))
    bits = max(4, (2 * texts.rdd.getNumPartitions() - 1).bit_length())
    ranges = _count_words(texts, folder, bits)
    lines = texts.count()
    starts, total, tokens = [0] * (1 << bits), 0, lines
    for part, words, count in ranges:
        starts[part], total, tokens = total, total + words, tokens + count
    if total + FIRST > 1 << 32:
        raise ValueError("words are numbered with 32 bits")
    starts = tuple(starts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            hashes, places, lengths = _words(row[-1] for row in rows)
            line, told = _lines(_numbered(folder, starts, bits, hashes)[0][places], lengths, order, BEGIN, END)
            grams, counts = _counted(_grams(line, np.flatnonzero(told), order))
            yield _sent(list(_messages(grams, [counts], bits)))

    level = texts.select("text").mapInArrow(send, _SENT)
    for n in range(order, 0, -1):
        level = level.groupBy("part").applyInArrow(_merged(n, folder, bits), _SENT)
    sums = {n: np.zeros(6, np.int64) for n in range(1, order + 1)}
    for row in level.collect():
        sums[-row["part"]] += np.frombuffer(bytes(row["body"]), "<i8")
    ones, twos, _, _, seen, more = sums[1].tolist()
    return Model(folder, order, bits, starts, tokens, total + (1 if lines else 0), lines,
                 tuple(_discounts(*sums[n][:4].tolist()) for n in range(1, order + 1)), (seen, ones, twos, more))


# Scoring ------------------------------------------------------------------------


def _values(model: Model, line: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """Values of the n-grams that end at some places; every distinct one is looked up once, in the order of the hashes."""
    hashes, place = np.unique(gram_hashes(_grams(line, ends, order)), return_inverse=True)
    return _look_up(f"{model.folder}/{order}", hashes, model.bits)[place]


def _probabilities(model: Model, line: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Probability of every told token after the tokens before it."""
    ends = np.flatnonzero(told)
    # The n-gram before a told token is its context in the next order; before a text's first token it ends in a mark.
    wanted = told.copy()
    wanted[ends - 1] = True
    every = np.flatnonzero(wanted) if model.order > 1 else ends
    own = told[every]
    seen, *follow = model.total
    lower = np.full(len(ends), 1.0 / (model.types + 1))
    context = np.array([[0, seen, *follow]], np.int64)
    for n in range(1, model.order + 1):
        values = _values(model, line, every if n < model.order else ends, n)
        count = values[own, 0] if n < model.order else values[:, 0]
        d = np.array([0.0, *model.discounts[n - 1]])
        total = context[:, 1]
        safe = np.maximum(total, 1)
        found = np.maximum(count - d[np.minimum(count, 3)], 0.0) / safe + context[:, 2:] @ d[1:] / safe * lower
        lower = np.where(total > 0, found, lower)
        if n < model.order:
            # Rows of ``every`` right before the told ones.
            context = values[np.flatnonzero(own) - 1]
    return lower


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (``doc_id``, ``held_out``, ``text``) with token counts, the base score, the model's score and perplexity."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            hashes, places, lengths = _words(row[-1] for row in rows)
            numbers, counts = _numbered(model.folder, model.starts, model.bits, hashes)
            line, told = _lines(numbers[places], lengths, model.order, BEGIN, END)
            tokens = lengths + 1
            first = np.cumsum(tokens) - tokens
            # In the told order each text's words are followed by its end.
            count = np.full(int(tokens.sum()), model.texts, np.int64)
            is_word = np.ones(len(count), bool)
            is_word[first + lengths] = False
            count[is_word] = counts[places]
            base = np.add.reduceat(np.log10((count + 1) / (model.tokens + model.types + 1)), first)
            score = np.add.reduceat(np.log10(_probabilities(model, line, told)), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()), pa.array(tokens),
                 pa.array(np.add.reduceat((count > 0).astype(np.int64), first)), pa.array(np.full(len(rows), model.tokens)),
                 pa.array(base), pa.array(score), pa.array(10.0 ** (-score / tokens))],
                names=[part.split()[0] for part in schema.split(", ")])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    """Whether a document is kept from training: the checksum of its id falls into one part."""
    check = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(check % parts == part, F.lit(False))


def language_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on all documents that are not held out, and score all."""
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return scores(marked, train(marked.filter(~F.col("held_out")), order))
