"""Span lists of the scanning operators: kinds in a fixed order, code point offsets, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

#: kind, start, end
Span = tuple[str, int, int]


def joined(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then kind in the given order, joined by commas."""
    place = {kind: i for i, kind in enumerate(kinds)}
    ordered = sorted(set(spans), key=lambda s: (s[1], place[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
