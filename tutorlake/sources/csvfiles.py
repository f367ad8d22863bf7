"""CSV exports as all-text DataFrames with a stable record number."""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tutorlake.functions.clean import blank_to_null
from tutorlake.functions.headers import sanitize_header
from tutorlake.functions.jsonfields import staged
from tutorlake.operators import dedup
from tutorlake.operators.totals import total_before
from tutorlake.session import stored

# Header names of the student export and their columns.
STUDENT_COLUMNS = {
    "#": "row_number", "Name": "name", "Email": "email", "Registration Number": "registration_number",
    "Contact Number Dial Code": "contact_number_dial_code", "Contact Number": "contact_number",
    "Alternate Contact Number Dial Code": "alternate_contact_number_dial_code",
    "Alternate Contact Number": "alternate_contact_number", "Date Of Birth": "date_of_birth",
    "Parent Name": "parent_name", "Parent Contact": "parent_contact", "Parent Email": "parent_email",
    "Address": "address", "city": "city", "State": "state", "Standard": "standard", "Date Created": "date_created",
    "Username": "username", "Gender": "gender", "Status": "status", "Username.1": "username_1",
    "Why do you want to study Sanskrit?": "why_study_sanskrit", "User Nice Name": "user_nice_name",
    "User Last Name": "user_last_name",
    "Would you like to teach Sanskrit through our portal?": "would_like_to_teach",
    "Teaching Experience, if any": "teaching_experience",
    "Is Sanskrit your mainstream education": "is_mainstream_education", "Objective": "objective",
    "User Age": "user_age", "Persona": "persona", "Objective Package": "objective_package",
    "Time per week (In Hours)": "time_per_week_hours", "Age_": "age_", "Facebook profile URL": "facebook_profile_url",
    "Instagram profile URL": "instagram_profile_url", "Pinterest profile URL": "pinterest_profile_url",
    "SoundCloud profile URL": "soundcloud_profile_url", "Tumblr profile URL": "tumblr_profile_url",
    "YouTube profile URL": "youtube_profile_url", "Wikipedia page about you (if one exists)": "wikipedia_url",
    "Twitter username (without @)": "twitter_username", "GST Number": "gst_number",
    "MySpace profile URL": "myspace_profile_url", "International Phone Number": "international_phone_number",
    "Website": "website", "Educational Qualification": "educational_qualification",
    "LinkedIn profile URL": "linkedin_profile_url", "Age ": "age_v2", "Gender_": "gender_",
    "Sanskrit Qualification": "sanskrit_qualification", "Areas of Interest in Sanskrit": "areas_of_interest",
    "Studying Sanskrit Currently? If yes, give details": "studying_sanskrit_currently",
    "What is your current education status?": "current_education_status", "Country Name": "country_name",
}
# Columns of the enrolment export, taken by name.
ENROLMENT_COLUMNS = (
    "user_id name email class_id class_name tutor_name total_classes present absent late excused start_date end_date "
    "master_batch_id master_batch_name classusers_start_date classusers_end_date batch_status cu_status cu_state "
    "institution_bundle_id archived_at bundle_id").split()


def _first_bytes(spark: SparkSession, file: str, size: int) -> bytes:
    """Begin of a file on whatever file system it is, unpacked where its name says that it is packed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        return bytes((codec.createInputStream(stream) if codec else stream).readNBytes(size))
    finally:
        stream.close()


def _header(spark: SparkSession, path: str, skip_lines: int) -> list[str]:
    """Header names; all files of one export share them.

    A header cell may hold line breaks, so lines are taken until no quote is open.  Only the begin of a file is read.
    """
    for file in sorted(spark.read.text(path).inputFiles()):
        size = 1 << 16
        while True:
            data = _first_bytes(spark, file, size)
            lines = data.decode("utf-8", "replace").split("\n")
            if len(data) == size:
                lines.pop()  # may go on behind these bytes
            inside = False
            for number, line in enumerate(lines[skip_lines:]):
                inside = _inside_after(line.removesuffix("\r"), inside)
                if not inside:
                    text = "\n".join(lines[skip_lines:skip_lines + number + 1])
                    return next(csv.reader(io.StringIO(text.removesuffix("\r"), newline="")), []) if data else []
            if len(data) < size:
                break
            size *= 4
    return []


#: A line that begins outside quotes and ends inside them: whole fields, then one whose quote stays open.  A field is quoted
#: if its first character is the quote; two quotes inside stand for one; what follows the closing quote is unquoted.
_OPENS = re.compile(r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+')
#: The rest of a quoted field, up to and with its closing quote.
_CLOSES = re.compile(r'(?:[^"]++|"")*+"[^,]*+')
_LINES = "file string, block long, outside boolean, inside boolean"
_PIECES = "file string, block long, at long, kind int, text string"
#: Kinds of pieces: a record; the begin of one that goes on after its split; the rest of one that began before.
_WHOLE, _OPEN, _REST = 0, 1, 2


def _inside_after(line: str, inside: bool) -> bool:
    """Whether a quote is open after a line, given whether one was open before it."""
    if '"' not in line:
        return inside
    if inside:
        closed = _CLOSES.match(line)
        if closed is None:
            return True
        if closed.end() == len(line):
            return False
        line = line[closed.end() + 1:]
    return _OPENS.fullmatch(line) is not None


def _split_key(file: str, block: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{file}\0{block}".encode(), digest_size=8).digest())


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """Lines of this task by the split that they were read from; a task reads its splits one after the other."""
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*(batch.column(i).to_pylist() for i in range(3))))
    for (file, block), group in itertools.groupby(rows, key=lambda row: row[:2]):
        yield file, block, (row[2] for row in group)


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a quote is open after each split, for both states before it."""
    for file, block, lines in _by_split(batches):
        outside, inside = False, True
        for line in lines:
            if '"' in line:
                outside, inside = _inside_after(line, outside), _inside_after(line, inside)
        yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "outside": [outside], "inside": [inside]})


def _pieces(entered_inside: frozenset[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts splits into records, once it is known in which of them a quote was open before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, lines in _by_split(batches):
            inside = _split_key(file, block) in entered_inside
            kind, held, at, out = _REST if inside else _WHOLE, [], 0, []
            for line in lines:
                held.append(line)
                inside = _inside_after(line, inside)
                if not inside:
                    text = "\n".join(held).removesuffix("\r")
                    if text or kind == _REST:  # empty lines are no records
                        out.append((at, kind, text))
                        at += kind == _WHOLE
                    kind, held = _WHOLE, []
                if len(out) >= 4096:
                    yield _batch(file, block, out)
                    out = []
            if held:
                out.append((at, _OPEN if kind == _WHOLE else _REST, "\n".join(held)))
            if out:
                yield _batch(file, block, out)

    return cut


def _batch(file: str, block: int, rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    at, kind, text = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(rows)), pa.array([block] * len(rows), pa.int64()), pa.array(at, pa.int64()), pa.array(kind, pa.int32()),
         pa.array(text, pa.string())], names=["file", "block", "at", "kind", "text"])


def _entered_inside(outcomes: DataFrame) -> frozenset[int]:
    """Splits before which a quote is open; one number for each of them.

    A split keeps the state, turns it, or sets it whatever it was.  The state before a split is what the last one that set it
    left, turned as often as splits did since; a file begins outside.  Only one row per split is put in order.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns, sets = F.col("outside") & ~F.col("inside"), F.col("outside") == F.col("inside")
    counted = outcomes.withColumn("turned", F.coalesce(F.sum(F.when(turns, 1).otherwise(0)).over(before), F.lit(0)))
    # What the state would have been at the file's begin to come out like this.
    origin = F.when(sets, (F.col("outside").cast("int") + F.col("turned")) % 2)
    entered = counted.withColumn("origin", origin).withColumn("from", F.coalesce(F.last("origin", ignorenulls=True).over(before), F.lit(0)))
    inside = entered.filter((F.col("from") + F.col("turned")) % 2 == 1).select("file", "block")
    return frozenset(_split_key(row.file, row.block) for row in inside.toLocalIterator())


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``at`` and ``text`` of every record of quoted CSV files, whose splits are read in parallel.

    Lines end in a line feed, with or without a carriage return.  Whether a split begins inside quotes depends on all
    before it: a first reading tells what each split makes of either state, which fixes the true ones, and the second cuts
    each split alone.  Records that cross the border of splits are put together from their pieces.
    """
    value = F.make_valid_utf8("value").alias("value")
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value)
    inside = _entered_inside(lines.mapInArrow(_outcomes, _LINES))
    pieces = stored(lines.mapInArrow(_pieces(inside), _PIECES), "csv-records")
    order = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    crossing = pieces.filter(F.col("kind") != _WHOLE).withColumn("record", F.count(F.when(F.col("kind") == _OPEN, 1)).over(order))
    opened = F.min(F.when(F.col("kind") == _OPEN, F.struct("block", "at"))).alias("own")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("rank"), "text"))), lambda p: p["text"])
    joined = crossing.groupBy("file", "record").agg(opened, F.concat_ws("\n", ordered).alias("text")).select(
        "file", "own.block", "own.at", F.regexp_replace("text", "\\r$", "").alias("text"))
    return pieces.filter(F.col("kind") == _WHOLE).select("file", "block", "at", "text").unionByName(joined)


def _records(spark: SparkSession, path: str, skip_lines: int, multi_line: bool) -> tuple[list[str], DataFrame]:
    """Header and records, columns ``c0 .. cn`` by position, with ``source_row``.

    The first record of every file goes: the header, or the line before it.  In the second case the first record that is
    left is the header, and it alone goes, whatever further records equal it.  With ``multi_line`` cells may hold line
    breaks; without it every line is a record, and one reading is saved.
    """
    if skip_lines not in (0, 1):
        raise ValueError("at most one line may precede the header")
    header = _header(spark, path, skip_lines)
    schema = StructType()
    for position in range(len(header)):
        schema.add(f"c{position}", StringType())
    if not header:
        empty = schema.add("source_row", LongType())
        return header, spark.createDataFrame([], empty)
    cells = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if multi_line:
        parsed = staged(_texts(spark, path), cells=F.from_csv("text", F.lit(schema.simpleString()[7:-1].replace(":", " ")), {**cells, "multiLine": "true"}))
        numbered = parsed.select("cells.*", F.col("file").alias("__file"), F.col("block").alias("__block"), F.col("at").alias("__id"))
    else:
        raw = spark.read.schema(schema).csv(path, header=True, encoding="UTF-8", **cells)
        numbered = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                              F.monotonically_increasing_id().alias("__id"))
    is_header = F.lit(bool(skip_lines))
    for position, name in enumerate(header if skip_lines else ()):
        is_header = is_header & F.col(f"c{position}").eqNullSafe(F.lit(name or None))
    return header, _with_source_row(numbered, is_header, int(multi_line))


def _with_source_row(records: DataFrame, is_header: Column, leading: int) -> DataFrame:
    """0-based record number in file order, without sorting or gathering the records.

    ``__id`` counts records in reading order inside a split; a small table of record counts per split supplies the offsets.
    The first ``leading`` records of every file (at most one) get no number and are left out, and so does a header that
    comes next, be it in the same split or in the one after.
    """
    splits = records.groupBy("__file", "__block").agg(
        F.min("__id").alias("__first"), F.count("*").alias("__n"), F.min(F.when(is_header, F.col("__id"))).alias("__head"),
        F.count_if(is_header & (F.col("__id") == 1)).alias("__second"))
    order = Window.partitionBy("__file").orderBy("__block")
    splits = splits.withColumn("__rank", F.row_number().over(order)).withColumn("__last", F.lag("__n").over(order))
    at_first = F.col("__head").eqNullSafe(F.col("__first")).cast("int")
    in_next = (F.col("__rank") == 2) & (F.col("__last") == 1) & F.lit(leading == 1)
    skip = F.when(F.col("__rank") == 1, F.lit(leading) + (F.col("__second") if leading else at_first)).when(in_next, at_first).otherwise(0)
    splits = splits.withColumn("__skip", skip).withColumn("__n", F.col("__n") - F.col("__skip")).drop("__head", "__second", "__rank", "__last")
    offsets = total_before(splits, ["__file", "__block"], "__n", "__offset", "csv-offsets").drop("__n")
    place = F.col("__id") - F.col("__first") - F.col("__skip")
    return records.join(offsets, ["__file", "__block"]).filter(place >= 0).withColumn(
        "source_row", place + F.col("__offset")).drop("__file", "__block", "__id", "__first", "__skip", "__offset")


def _by_name(header: Sequence[str]) -> dict[str, str]:
    # A repeated header name stands for its last column.
    return {name: f"c{position}" for position, name in enumerate(header)}


def read_csv_mapped(spark: SparkSession, path: str, mapping: Mapping[str, str], skip_lines: int = 0,
                    multi_line: bool = True) -> DataFrame:
    """CSV columns by header name, renamed; missing columns and blank cells are NULL."""
    header, records = _records(spark, path, skip_lines, multi_line)
    found = _by_name(header)
    return records.select("source_row", *[
        (blank_to_null(found[name]) if name in found else F.lit(None).cast("string")).alias(column)
        for name, column in mapping.items()])


def read_students(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv_mapped(spark, path, STUDENT_COLUMNS, skip_lines=1, multi_line=multi_line)


def read_enrolments(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv_mapped(spark, path, {c: c for c in ENROLMENT_COLUMNS}, multi_line=multi_line)


def read_csv_dynamic(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV whose columns follow its own header, made safe and unique."""
    header, records = _records(spark, path, 0, multi_line)
    found = _by_name(header)
    return records.select("source_row", *[
        blank_to_null(found[name]).alias(column) for name, column in zip(header, sanitize_header(header))])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_students_if_present(spark: SparkSession, path: str) -> DataFrame:
    """Like :func:`read_students`; a missing file has no rows."""
    if exists(spark, path):
        return read_students(spark, path)
    columns = ", ".join(f"{c} string" for c in STUDENT_COLUMNS.values())
    return spark.createDataFrame([], f"source_row bigint, {columns}")


def new_records(target: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose number the target lacks: loading a file again adds nothing."""
    return dedup.only_new(target, records, ["source_row"], ["source_row"])
