"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names and units turn into typed placeholders, all else into its lower-cased
letters and digits.  Windows of template tokens of the benchmark and of the documents meet in a hash join.  The key
numbers the placeholders of a window by first occurrence of their value, so only windows whose slots repeat in the same
pattern meet; across the windows of one alignment a benchmark value must always stand for the same document value.
That catches questions with other numbers and names and leaves texts alone that merely have the same shape.

Items so dense in slots that none of their windows is mostly plain words are matched as a whole: all their windows that
hold a plain word must be found along one alignment, with consistent slots.

A second key of a window holds its lower-cased token values alone.  It finds verbatim copies whatever the types of their
tokens, also of items that are dense in numbers and names, or too short for a template.

Documents send only windows whose plain template or whose values may be in the benchmark: a bit table each, of fixed size,
says so.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.common import unused, window_hashes, with_row, words_of
from tutorlake.session import stored

#: Tokens of a window.  A shorter benchmark item is one window of its own length; a template has LEAST tokens.
WIDTH, LEAST = 13, 5
#: Share of plain words from which a template window is evidence alone, and plain words that a template item has at least.
PLAIN, ANCHORS = 0.5, 2
#: Cells of each bit table that is sent to every task: 512 KB whatever the benchmark's size.
CELLS = 1 << 22

# Unit words, number words and common first names.
UNITS = frozenset((
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg",
    "gram", "grams", "kilogram", "kilograms", "ton", "tons", "ounce", "ounces", "pound", "pounds", "ml", "l", "liter", "liters",
    "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month",
    "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "degree", "degrees",
    "watt", "watts", "volt", "volts", "meter", "meters", "metre", "metres", "kilometer", "kilometers"))
NUMBER_WORDS = frozenset((
    "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen",
    "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy",
    "eighty", "ninety", "hundred", "thousand", "million"))
NAMES = frozenset((
    "alice", "anna", "bob", "carlos", "charlie", "david", "emily", "emma", "eva", "frank", "george", "grace", "hannah", "henry",
    "jack", "james", "jane", "jim", "john", "julia", "kate", "laura", "linda", "lisa", "lucas", "lucy", "maria", "mark", "mary",
    "mia", "mike", "natalia", "nina", "oliver", "paul", "peter", "robert", "sam", "sarah", "sofia", "susan", "tim", "tom", "weng"))
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:[a-z]{1,3}|%)?\Z")
_EDGES = re.compile(r"^\W+|\W+\Z")
WORD_KIND, NUMBER, NAME_LIKE, NAME, UNIT_LIKE, NOTHING = range(6)
_NUMBER_BYTES, _UNIT_BYTES = (frozenset(w.encode() for w in words) for words in (NUMBER_WORDS, UNITS))


class _Index(dict):
    """Numbers of words; a new word is added when it is first asked for."""

    def __init__(self, add: Callable[[bytes], int]) -> None:
        super().__init__()
        self.add = add

    def __missing__(self, raw: bytes) -> int:
        return self.add(raw)


class Lexicon:
    """Kind, hash and sentence end of each raw word; emptied when it has grown to its bound."""
    BOUND = 400_000

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.index = _Index(self._add)
        self.kinds, self.hashes, self.ends = array("b"), array("Q"), array("b")

    def _add(self, raw: bytes) -> int:
        if raw.isalpha() and raw.islower():  # most words: nothing to strip or fold
            kind = NUMBER if raw in _NUMBER_BYTES else UNIT_LIKE if raw in _UNIT_BYTES else WORD_KIND
            low, end = raw, False
        else:
            kind, low, end = self._read(raw.decode("utf-8", "surrogatepass"))
        self.index[raw] = place = len(self.kinds)
        self.kinds.append(kind)
        self.hashes.append(xxhash.xxh3_64_intdigest(low))
        self.ends.append(end)
        return place

    def _read(self, text: str) -> tuple[int, bytes, bool]:
        letters = text.isalpha()  # such words have no edges, no digits and end no sentence
        core = text if letters else _EDGES.sub("", text)
        low = core.lower()
        if not low:
            kind = NOTHING
        elif low in NUMBER_WORDS or not letters and _NUMBER.match(low):
            kind = NUMBER
        elif low in NAMES and core[0].isupper():
            kind = NAME
        elif low in UNITS:
            kind = UNIT_LIKE
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            kind = NAME_LIKE
        else:
            kind = WORD_KIND
        end = not letters and text.rstrip("\"')]»”").endswith((".", "!", "?", ":"))
        return kind, low.encode("utf-8", "surrogatepass"), end

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Types (0: plain word), value hashes, plain template hashes and word numbers of a text's tokens."""
        words = words_of(text)
        if len(self.index) > self.BOUND:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if not len(at):
            return np.empty(0, np.int8), np.empty(0, np.uint64), np.empty(0, np.uint64), at
        kinds, values = np.frombuffer(self.kinds, np.int8)[at], np.frombuffer(self.hashes, np.uint64)[at]
        ends = np.frombuffer(self.ends, np.bool_)[at]
        kept = np.flatnonzero(kinds != NOTHING)
        kinds, values, ends = kinds[kept], values[kept], ends[kept]
        starts = np.concatenate(([True], ends[:-1])) if len(ends) else ends
        after_number = np.concatenate(([False], kinds[:-1] == NUMBER)) if len(kinds) else ends
        types = np.zeros(len(kinds), np.int8)
        types[kinds == NUMBER] = 1
        types[(kinds == NAME) | ((kinds == NAME_LIKE) & ~starts)] = 2
        types[(kinds == UNIT_LIKE) & after_number] = 3
        return types, values, np.where(types > 0, types.astype(np.uint64), values), kept


def window_key(types: np.ndarray, values: np.ndarray) -> tuple[int, list[int]]:
    """Key of a window whose placeholders are numbered by first occurrence, and its slot values in order."""
    seen: dict[tuple[int, int], int] = {}
    parts, slots = [], []
    for kind, value in zip(types.tolist(), values.tolist()):
        if kind:
            slots.append(value)
            parts.append(f"{kind}:{seen.setdefault((kind, value), len(seen))}")
        else:
            parts.append(str(value))
    signed = xxhash.xxh3_64_intdigest(" ".join(parts).encode())
    return signed - (1 << 64) if signed >= 1 << 63 else signed, slots


def _signed(numbers: list[int]) -> list[int]:
    return [n - (1 << 64) if n >= 1 << 63 else n for n in numbers]


_WINDOWS = "id long, at int, width int, word int, last_word int, loose long, key long, slots array<long>, same boolean, needed int"


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes whose cell is set."""
    cell = (hashes % np.uint64(CELLS)).astype(np.int64)
    return np.flatnonzero(bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)


def _windows(table: DataFrame, widths: list[int] | None, cells, whole_items: bool) -> DataFrame:
    """Windows of the texts (``id``, ``text``), by template and by value (``same``): all, or those whose cell is set."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, bits = Lexicon(), None if cells is None else np.frombuffer(cells.value, np.uint8).reshape(2, -1)
        for batch in batches:
            out = []
            for row_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                types, values, plain, words = lexicon.tokens(text.as_py())
                own = [min(WIDTH, len(types))] if whole_items else widths
                for width in own:
                    if width < 1 or len(types) < width:
                        continue
                    exact = window_hashes(values, width)
                    for i in (np.arange(len(exact)) if bits is None else _set(bits[1], exact)).tolist():
                        number = _signed([int(exact[i])])
                        out.append((row_id, i, width, int(words[i]), int(words[i + width - 1]), *number, *number, [], True, 0))
                    if width < LEAST:
                        continue
                    loose = window_hashes(plain, width)
                    found = np.arange(len(loose)) if bits is None else _set(bits[0], loose)
                    words_before = np.concatenate(([0], np.cumsum(types == 0)))
                    held = words_before[found + width] - words_before[found]
                    needed = 0
                    if whole_items and (held >= PLAIN * width).any():
                        found = found[held >= PLAIN * width]
                    elif whole_items:
                        found = found[(held > 0) & (words_before[-1] >= ANCHORS)]
                    else:
                        found = found[held > 0]
                    keyed = [(i, *window_key(types[i:i + width], values[i:i + width])) for i in found.tolist()]
                    if whole_items and not (held >= PLAIN * width).any():
                        needed = len({(key, *slots) for _, key, slots in keyed})
                    for i, key, slots in keyed:
                        out.append((row_id, i, width, int(words[i]), int(words[i + width - 1]),
                                    *_signed([int(loose[i])]), key, _signed(slots), False, needed))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.bool_(), pa.int32())
            names = ("id", "at", "width", "word", "last_word", "loose", "key", "slots", "same", "needed")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in zip(kinds, zip(*out))], names)

    return table.mapInArrow(cut, _WINDOWS)


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_windows``, ``first_word``, ``last_word``, ``verbatim``: where documents hold benchmark items.

    One row per document, item and alignment; items that share a window are all named, of items with one text the
    smallest id.  ``verbatim`` says that all slots have the item's values.  An item of fewer than LEAST tokens is found verbatim only,
    and so is one that is dense in slots and has fewer than ANCHORS plain words.
    Texts that are missing or empty match nothing; repeated
    documents are reported once; a missing doc_id is reported as such.  Items without id or text are left out.
    Clashing further columns are ignored.
    """
    spark = documents.sparkSession
    items = benchmark.filter("item_id IS NOT NULL").groupBy(F.col("text").cast("string").alias("text")).agg(
        F.min(F.col("item_id").cast("long")).alias("id")).select("id", "text")
    items = stored(_windows(items, None, None, True), "leak-items")
    # Items with one template and other values stay apart, so that each one's slots are checked along its whole alignment.
    known = stored(items.groupBy("same", "key", "id", "slots").agg(F.min("at").alias("item_at"), F.max("needed").alias("needed"))
                   .select("same", "key", F.col("id").alias("item_id"), "item_at", "needed", F.col("slots").alias("item_slots")), "leak-keys")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most WIDTH of them
    bits = np.zeros(2 * CELLS // 8, np.uint8)
    cell = F.col("loose").bitwiseAND(F.lit(CELLS - 1)).cast("int") + F.when(F.col("same"), CELLS).otherwise(0)
    marked = items.select(cell.alias("cell")).distinct().toPandas()["cell"].to_numpy()  # at most 2 * CELLS numbers
    np.bitwise_or.at(bits, marked >> 3, (1 << (marked & 7)).astype(np.uint8))
    sent = spark.sparkContext.broadcast(bits.tobytes())
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    hits = _windows(texts, widths, sent, False).drop("needed").dropDuplicates(["id", "at", "width", "same", "key"]).join(known, ["same", "key"])
    hits = stored(hits.withColumn("shift", F.col("at") - F.col("item_at")), "leak-hits")
    slots = hits.select("id", "item_id", "shift", F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
    torn = (slots.groupBy("id", "item_id", "shift", "s.item_slots").agg(F.min("s.slots").alias("lo"), F.max("s.slots").alias("hi"))
            .filter("lo <> hi").select("id", "item_id", "shift").distinct())
    # A window that is found by template and by value counts once.
    equal = F.col("same") | (F.col("slots") == F.col("item_slots"))
    once = hits.groupBy("id", "item_id", "shift", "at", "width").agg(
        F.min("word").alias("word"), F.max("last_word").alias("last_word"), F.max(equal).alias("equal"),
        F.max(~F.col("same")).alias("template"), F.max("needed").alias("needed"))
    groups = once.groupBy("id", "item_id", "shift").agg(
        F.count(F.lit(1)).alias("n_windows"), F.min("word").alias("first_word"), F.max("last_word").alias("last_word"),
        F.min("equal").alias("verbatim"), F.max("equal").alias("some_verbatim"),
        (F.count_if("template") >= F.max("needed")).alias("complete"))
    torn = torn.select(F.col("id").alias("i"), F.col("item_id").alias("t"), F.col("shift").alias("s"), F.lit(True).alias("torn"))
    groups = groups.join(torn, F.col("id").eqNullSafe(F.col("i")) & (F.col("item_id") == F.col("t")) & (F.col("shift") == F.col("s")), "left")
    return groups.filter("some_verbatim OR torn IS NULL AND complete").select(
        F.col("id").alias("doc_id"), "item_id", "n_windows", "first_word", "last_word", "verbatim")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold benchmark items; a row without id stays, as nothing can name it."""
    key = unused(documents, "_id")
    found = contaminated(documents, benchmark).filter("doc_id IS NOT NULL").select(F.col("doc_id").alias(key)).distinct()
    return documents.join(found, F.col("doc_id") == F.col(key), "left_anti")


def clean_rows(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without those that hold benchmark items, whatever their ids."""
    rows, row = with_row(documents, "leak-rows")
    found = contaminated(rows.select(F.col(row).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(*documents.columns)
