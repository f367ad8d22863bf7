"""Header names of dynamic CSV files.

A header is one short line, so it is handled on the driver; the same rule is
also offered as a column expression for names held in data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tutorlake.functions.clean import strip


def safe_name(name: str) -> str:
    """Lower case, every other run of characters one underscore, none at the ends."""
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def sanitize_header(names: Iterable[str]) -> list[str]:
    """Safe names; repeated ones get ``_1``, ``_2`` and so on."""
    seen: dict[str, int] = {}
    result = []
    for name in map(safe_name, names):
        repeats = seen.get(name, -1) + 1
        seen[name] = repeats
        result.append(f"{name}_{repeats}" if repeats else name)
    return result


def safe_name_column(c: Column | str) -> Column:
    """:func:`safe_name` for a column of names."""
    return F.btrim(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), F.lit("_"))
