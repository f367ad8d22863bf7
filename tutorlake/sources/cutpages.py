"""Landed JSON pages of any size, cut into their rows by structure.

A page too large for one value is read in splits, as text between ``},``.  What a byte means depends on all bytes before it:
whether a string is open, how deep it lies, and in which list.  Three readings settle that, each with one small row per
split: the first tells how a split turns the string state and the depth, for either state before it; the second, knowing
both, which list was opened last; the third cuts each split alone.  Entries that cross the border of splits are put
together from their pieces.  Nothing but an entry has to fit a value.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tutorlake.operators.totals import total_before
from tutorlake.session import stored

_BETWEEN = "},"
_STRINGS = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)
_TOKENS = re.compile(r'"(?:[^"\\]++|\\.)*+"|[\[\]{},]|"', re.DOTALL)

#: Kinds of pieces: an entry; the begin of one that goes on after its split; the rest of one that began before.
_WHOLE, _OPEN, _REST = 0, 1, 2
_Place = tuple[str, int]
#: Before a split: string open, depth, kind of the page's own bracket, kind of the second one, key of the latter.
_State = tuple[bool, int, str, str, str]


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*(batch.column(i).to_pylist() for i in range(3))))
    for (file, block), group in itertools.groupby(rows, key=lambda row: row[:2]):
        yield file, block, (row[2] + _BETWEEN for row in group)


def _effect(text: str, inside: bool) -> tuple[bool, int]:
    """String state after a text, and by how much deeper it ends."""
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return True, 0
        text = text[end.end():]
    bare = _STRINGS.sub("", text)
    opened = bare.find('"')
    if opened >= 0:
        bare = bare[:opened]
    return opened >= 0, bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, texts in _by_split(batches):
        ends = [(False, 0), (True, 0)]
        for text in texts:
            steps = [_effect(text, inside) for inside, _ in ends]
            ends = [(inside, depth + deeper) for (_, depth), (inside, deeper) in zip(ends, steps)]
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": [block], "outside": [ends[0][0]], "deeper_outside": [ends[0][1]], "inside": [ends[1][0]], "deeper_inside": [ends[1][1]]})


def _walk(text: str, state: _State, cut: Callable[[int, int, _State], None]) -> _State:
    """Follow the brackets of a text; ``cut(begin, end, state)`` where an entry ends.

    Entries are the members of the page's own bracket, and where such a member is a list, the members of that.
    """
    inside, depth, top, second, key = state
    at = 0
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return state
        at, inside = end.end(), False
    last = ""
    for token in _TOKENS.finditer(text, at):
        sign = token.group()
        if sign[0] == '"':
            if len(sign) == 1:
                return True, depth, top, second, key
            if depth == 1:
                last = sign
        elif sign in "[{":
            depth += 1
            if depth == 1:
                top = sign
            elif depth == 2:
                second, key = sign, last if top == "{" else ""
        elif sign in "]}":
            depth -= 1
            if depth == 0:
                cut(token.start(), token.end(), (False, 0, top, second, key))
                return False, -1, top, second, key
        elif depth == 1 or (depth == 2 and top == "{" and second == "["):
            cut(token.start(), token.end(), (False, depth, top, second, key))
            last = ""
    return inside, depth, top, second, key


def _openers(before: dict[_Place, tuple[bool, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, texts in _by_split(batches):
            state = (*before[file, block], "", "", "")
            # Where the page's own bracket lies before this split its kind does not matter here: a key is kept for both.
            state = (*state[:2], "{" if state[1] else "", *state[3:])
            for text in texts:
                if state[1] < 0:
                    break
                state = _walk(text, state, lambda *_: None)
            began = before[file, block][1] == 0
            yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "top": [state[2] if began else ""], "second": [state[3]], "key": [state[4]]})

    return find


_PIECES = "file string, block long, at long, kind int, entry int, left int, top string, key string, text string"


def _pieces(before: dict[_Place, _State]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries of each split, with the depth they begin and end in, the page's bracket and the key of their list."""
    names = [part.split()[0] for part in _PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, texts in _by_split(batches):
            state = before[file, block]
            held: list[str] = []
            out: list[tuple] = []
            # The depth, key and kind of the entry that is being read; one that began before belongs to its begin.
            own = [state[1], state[4] if state[1] == 2 else "", _WHOLE if (state[1], block) == (0, 0) else _REST]
            at = 0
            for text in texts:
                if state[1] < 0:
                    break
                done = 0

                def end(begin: int, after: int, now: _State, text: str = text) -> None:
                    nonlocal done, at, held
                    held.append(text[done:begin] + (text[begin:after] if now[1] == 0 else ""))
                    out.append((at, own[2], own[0], now[1], now[2], own[1], "".join(held)))
                    at += own[2] == _WHOLE
                    held, done = [], after
                    own[:] = [now[1], now[4] if now[1] == 2 else "", _WHOLE]

                state = _walk(text, state, end)
                if state[1] >= 0:
                    held.append(text[done:])
                if len(out) >= 4096:
                    yield _batch(file, block, out, names)
                    out.clear()
            if state[1] >= 0 and held:
                out.append((at, _OPEN if own[2] == _WHOLE else _REST, own[0], state[1], state[2], own[1], "".join(held)))
            if out:
                yield _batch(file, block, out, names)

    return cut


def _batch(file: str, block: int, rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
    columns = [[file] * len(rows), [block] * len(rows), *map(list, zip(*rows))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _in_order(rows: DataFrame) -> Iterator:
    """One small row per split, file by file."""
    return rows.orderBy("file", "block").toLocalIterator()


def cut_pages(spark: SparkSession, paths: Sequence[str], limit: int, lists: Sequence[str]) -> DataFrame:
    """``page``, ``value`` (JSON text), ``size`` and ``first`` of the pages above ``limit`` bytes, one row per entry.

    Each value is a page of the same shape with one entry: ``[entry]``, ``{"key": [entry]}`` or ``{"key": value}``.  ``first`` is
    the entry's place in its list or page.  Keys among ``lists`` that the whole page holds are there as empty lists, or
    null, so that the choice among them stays that of the whole page.
    """
    lines = spark.read.text(list(paths), lineSep=_BETWEEN).where(F.col("_metadata.file_size") > limit).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_size").alias("size"))
    texts = lines.drop("size")
    places: dict[_Place, tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    for row in _in_order(texts.mapInArrow(_effects, "file string, block long, outside boolean, deeper_outside long, inside boolean, deeper_inside long")):
        if row.file != file:
            file, inside, depth = row.file, False, 0
        places[row.file, row.block] = (inside, depth)
        inside, depth = (row.inside, depth + row.deeper_inside) if inside else (row.outside, depth + row.deeper_outside)
    states: dict[_Place, _State] = {}
    file, top, second, key = None, "", "", ""
    for row in _in_order(texts.mapInArrow(_openers(places), "file string, block long, top string, second string, key string")):
        if row.file != file:
            file, top, second, key = row.file, "", "", ""
        states[row.file, row.block] = (*places[row.file, row.block], top, second, key)
        top = top or row.top
        second, key = (row.second, row.key) if row.second else (second, key)
    pieces = stored(texts.mapInArrow(_pieces(states), _PIECES), "page-entries")

    order = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    crossing = pieces.filter(F.col("kind") != _WHOLE).withColumn("record", F.count(F.when(F.col("kind") == _OPEN, 1)).over(order))
    own = F.min(F.when(F.col("kind") == _OPEN, F.struct("block", "at", "entry", "top", "key"))).alias("own")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("rank"), "text"))), lambda p: p["text"])
    joined = crossing.groupBy("file", "record").agg(
        own, F.max_by("left", "block").alias("left"), F.max("top").alias("top"), F.concat_ws("", ordered).alias("text"))
    joined = joined.select("file", "own.block", "own.at", "own.entry", "left", "top", "own.key", "text")
    entries = pieces.filter(F.col("kind") == _WHOLE).select("file", "block", "at", "entry", "left", "top", "key", "text").unionByName(joined)

    # What is left of the brackets around an entry goes; a member of an object gives up its key, a list its bracket.
    in_object, text = F.col("top") == "{", F.col("text")
    text = F.when(F.col("entry") == 0, F.regexp_replace(text, r"^\s*[\[{]", "")).otherwise(text)
    text = F.when(F.col("left") == 0, F.regexp_replace(text, r"[\]}]\s*$", "")).otherwise(text)
    member = in_object & (F.col("entry") < 2)
    bare = entries.withColumn("text", text)
    name = F.regexp_extract("text", r'(?s)^\s*("(?:[^"\\]|\\.)*+")\s*:', 1)
    value = F.regexp_replace("text", r'(?s)^\s*"(?:[^"\\]|\\.)*+"\s*:\s*', "")
    bare = bare.withColumn("key", F.when(member, name).otherwise(F.col("key"))).withColumn("text", F.when(member, value).otherwise(F.col("text")))
    is_list = in_object & ((F.col("entry") == 2) | F.col("text").startswith("["))
    bare = bare.withColumn("is_list", is_list)
    opens, closes = member & F.col("is_list"), F.col("is_list") & (F.col("left") < 2)
    text = F.when(opens, F.substr("text", F.lit(2))).otherwise(F.col("text"))
    bare = bare.withColumn("text", text).withColumn("text", F.when(closes, F.regexp_replace("text", r"\]\s*$", "")).otherwise(F.col("text")))
    bare = bare.filter((F.trim("text") != "") | F.col("is_list"))

    # Keys of the whole page that matter for the choice among its lists.
    known = F.when(F.col("key").isin([f'"{k}"' for k in lists]), F.concat(
        "key", F.when(F.col("is_list"), F.lit(":[]")).when(F.trim("text") == "null", F.lit(":null")).otherwise(F.lit(":{}"))))
    # A page whose own bracket never closes is broken, and so are all its values.
    shape = bare.groupBy("file").agg(F.collect_set(known).alias("keys"), F.max(F.col("left") == 0).alias("closed"))
    # An empty list stays as a page without entries, so that it is a page still.
    counted = bare.filter((F.trim("text") != "") | F.col("is_list")).withColumn("group", F.when(F.col("is_list"), F.col("key")).otherwise(""))
    placed = total_before(counted.withColumn("n", F.lit(1)), ["file", "block", "at"], "n", "rank", "page-places")
    # Members of a page count among themselves, entries of a list among those of the list, which stand together.
    least = placed.groupBy("file", "group").agg(F.min("rank").alias("least"))
    others = F.filter("keys", lambda k: ~F.startswith(k, F.concat("key", F.lit(":"))))
    own = F.when(F.col("is_list"), F.concat("key", F.lit(":["), "text", F.lit("]"))).otherwise(F.concat("key", F.lit(":"), "text"))
    whole = F.when(in_object, F.concat(F.lit("{"), F.array_join(F.concat(others, F.array(own)), ","), F.lit("}"))).otherwise(
        F.concat(F.lit("["), "text", F.lit("]")))
    sizes = lines.groupBy("file").agg(F.max("size").alias("size"))
    return (placed.join(least, ["file", "group"]).join(shape, "file").join(sizes, "file")
            .select(F.col("file").alias("page"), F.when(F.col("closed"), whole).alias("value"), "size", (F.col("rank") - F.col("least")).alias("first")))
