"""Cleaning and typing of raw text, as native column expressions.

Raw text never reaches a plain cast: ANSI mode would fail the job on one bad
value, so everything goes through a pattern guard plus ``try_cast``/``try_to_*``
and bad input becomes NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Text that stands for "no value" in the source systems.
NULL_TOKENS = ("", "nan", "None", "NaN")
NULL_TOKENS_SHORT = ("", "nan", "None")
EPOCH_NULL_TOKENS = ("", "0", "None")
SPREADSHEET_ERROR = "#VALUE!"

#: Epoch seconds of the first second of the year 1 and the last of the year 9999.
EPOCH_RANGE = (-62135596800, 253402300799)

# Date and time layouts, tried in this order.
ATTENDANCE_DATE_FORMATS = ("d MMM yyyy", "yyyy-M-d", "d-M-yyyy", "d/M/yyyy", "M/d/yyyy")
LIFECYCLE_DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy-M-d")
BATCH_TIMESTAMP_FORMATS = (
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d H:m:s",
    "yyyy-M-d",
    "d-M-yyyy h:m a 'IST'",
    "d/M/yyyy",
    "M/d/yyyy",
)
STUDENT_TIMESTAMP_FORMAT = "M/d/yyyy H:m"

#: All characters that count as white space at the ends of a text.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)

_WHOLE = r"^[+-]?[0-9]+$"
#: A whole number as it mostly comes: nothing but blanks around it, which a cast drops by itself.
_PLAIN_WHOLE = r"^ *[+-]?[0-9]+ *\z"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space, including Unicode spaces, from both ends."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """Empty text becomes NULL; nothing else changes (raw CSV cells)."""
    return F.nullif(_col(c), F.lit(""))


def clean_text(c: Column | str, null_tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Stripped text, or NULL when it is one of the no-value tokens."""
    text = strip(c)
    return F.when(~text.isin(*null_tokens), text)


def safe_int(c: Column | str, commas: bool = False) -> Column:
    """Whole number or NULL; with ``commas`` thousands separators are dropped."""
    raw = _col(c).cast("string")
    raw = F.replace(raw, F.lit(","), F.lit("")) if commas else raw
    text = strip(raw)
    return F.when(raw.rlike(_PLAIN_WHOLE), raw.try_cast("bigint")).otherwise(F.when(text.rlike(_WHOLE), text.try_cast("bigint")))


def safe_bigint(c: Column | str) -> Column:
    """Whole part of a decimal text (``'12.9'`` is 12) or NULL."""
    text = strip(c)
    return F.when(text.rlike(_DECIMAL), text.try_cast("double").try_cast("bigint"))


def safe_float(c: Column | str, null_tokens: Sequence[str] = (SPREADSHEET_ERROR,)) -> Column:
    """Number without thousands separators, or NULL."""
    text = strip(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))
    return F.when(text.rlike(_DECIMAL) & ~text.isin(*null_tokens), text.try_cast("double"))


def epoch_or_null(c: Column | str) -> Column:
    """Epoch seconds as text; blank, zero and ``None`` mean no value."""
    raw = _col(c).cast("string")
    text = strip(raw)
    return F.when(raw.rlike(_PLAIN_WHOLE), F.when(F.trim(raw) != "0", raw.try_cast("bigint"))).otherwise(
        F.when(~text.isin(*EPOCH_NULL_TOKENS), safe_int(text)))


#: What each letter run of a layout may look like; other characters stand for themselves.
_SHAPES = {
    "d": "(0?[1-9]|[12][0-9]|3[01])", "M": "(0?[1-9]|1[0-2])", "MMM": "[A-Za-z]{3}", "yyyy": "[0-9]{4}",
    "H": "([01]?[0-9]|2[0-3])", "h": "(0?[1-9]|1[0-2])", "m": "[0-5]?[0-9]", "s": "[0-5]?[0-9]", "a": "[AaPp][Mm]",
}


def _shape(fmt: str) -> str:
    """Pattern of the texts a layout can read.

    A failed parse costs an exception per value; the pattern keeps texts of
    other layouts away, so that only impossible dates such as 31/2 still fail.
    """
    tokens = re.findall(r"'[^']*'|d+|M+|y+|H+|h+|m+|s+|a|.", fmt)
    return "^" + "".join(_SHAPES.get(t) or re.escape(t.strip("'")) for t in tokens) + "$"


def _squeezed(text: Column) -> Column:
    """Runs of white space as one blank, as the layouts have it.

    All layouts of a column are held against this one text, so it is worked out once per value, and few values need it.
    """
    return F.when(text.rlike(r"\s\s|[^\S ]"), F.regexp_replace(text, r"\s+", " ")).otherwise(text)


def parse_date(c: Column | str, formats: Sequence[str] = ATTENDANCE_DATE_FORMATS) -> Column:
    """First layout that fits gives the date, otherwise NULL."""
    raw = _col(c).cast("string")
    text = _squeezed(strip(raw))

    def read(t: Column, end: str) -> list[Column]:
        return [F.when(t.rlike(_shape(fmt)[:-1] + end), F.try_to_date(t, fmt)) for fmt in formats]

    # A text that has a layout as it is needs no cleaning; few do not.
    return F.coalesce(*read(raw, r"\z"), *read(text, "$"))


def _zoned(text: Column, fmt: str, zone: str) -> Column:
    # The zone travels with the text, so the session time zone has no influence.
    text = _squeezed(text)
    stamp = F.try_to_timestamp(F.concat(text, F.lit(" " + zone)), F.lit(fmt + " VV"))
    return F.when(text.rlike(_shape(fmt)), stamp)


def parse_timestamp(
    c: Column | str,
    formats: Sequence[str] = BATCH_TIMESTAMP_FORMATS,
    zone: str = "UTC",
) -> Column:
    """Epoch number, or the part before ``+`` read with the first layout that fits."""
    text = clean_text(c)
    number = F.when(text.rlike(_DECIMAL), text.try_cast("double"))
    head = strip(F.substring_index(text, "+", 1))
    return F.coalesce(epoch_ts(number), *[_zoned(head, fmt, zone) for fmt in formats])


def parse_local_timestamp(
    c: Column | str, fmt: str = STUDENT_TIMESTAMP_FORMAT, zone: str = "+05:30"
) -> Column:
    """Wall-clock text of a known zone as an instant."""
    return _zoned(clean_text(c, ("", "None")), fmt, zone)


def iso_epoch(c: Column | str) -> Column:
    """ISO-8601 text as epoch seconds; text without an offset counts as UTC."""
    text = strip(c)
    zoned = F.when(text.rlike(r"[T ].*(Z|[+-][0-9]{2}:?[0-9]{2})$"), text).otherwise(
        F.concat(text, F.when(text.rlike("[T ]"), F.lit("Z")).otherwise(F.lit("T00:00:00Z")))
    )
    return F.unix_seconds(zoned.try_cast("timestamp"))


def epoch_fits(c: Column | str) -> Column:
    """Whether epoch seconds lie in the years 1 to 9999; a count of milliseconds does not."""
    return _col(c).between(*EPOCH_RANGE)


def epoch_ts(c: Column | str) -> Column:
    """Epoch seconds as an instant; NULL for numbers that are no date between the years 1 and 9999."""
    seconds = _col(c)
    return F.timestamp_seconds(F.when(epoch_fits(seconds), seconds))


def local_datetime(ts: Column | str, zone: str = "UTC") -> Column:
    """Wall clock of an instant in ``zone``, whatever the session time zone is."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_date(ts: Column | str, zone: str = "UTC") -> Column:
    """Calendar date of an instant in ``zone``."""
    return local_datetime(ts, zone).cast("date")


def day_window(day: Column | str, zone: str = "Asia/Kolkata") -> tuple[Column, Column]:
    """First and last epoch second of a local calendar day."""
    start = F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(day).cast("timestamp_ntz"))
    first = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), start)
    return first, first + F.lit(86399)


def falsy_coalesce(*cols: Column | str, zero: bool = False) -> Column:
    """First value that is neither NULL nor empty (nor zero); the last one as it is."""
    *head, last = [_col(c) for c in cols]
    skipped = [F.nullif(c, F.lit(0)) if zero else F.nullif(c, F.lit("")) for c in head]
    return F.coalesce(*skipped, last)


def normalise_email(c: Column | str) -> Column:
    return F.lower(strip(c))


def synthetic_id(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def row_payload(*cols: Column | str) -> Column:
    """The row as JSON text, NULL fields kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
