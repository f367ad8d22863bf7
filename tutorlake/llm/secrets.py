"""Secret scan by assignment-aware lexing.

Beside three base patterns the scan reads assignments of source and configuration syntax (``name = "literal"``,
``name: literal``, ``"name": "literal"``, ``name := literal``, ``name => literal``, typed and chained forms) into pairs of
name and literal, joins literals that are added up, follows names that stand for earlier literals, and scores each literal
by its target name and its own shape.  A text is read from left to right once; each step looks at what lies between
two operators only.  A sum is kept as its parts with what its score needs (length, counts of characters, both ends), never
as a string, so sums of sums of any length cost one merge of character counts each, and a part is reported once per kind.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.llm.spans import Span, digest, joined

#: Kinds in their order: base kinds, literals of sensitive names, literals that reach such a name through others.
BASE, KINDS = ("assign", "access", "hex"), ("assign", "access", "hex", "literal", "propagated")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_OPERATOR = re.compile(r":=|=>|==+|!=|<=|>=|[:=]")
_STRING = re.compile(r'"""(?:[^\\]|\\.)*?"""|' r"'''(?:[^\\]|\\.)*?'''|" r'"(?:[^"\\\n]|\\.)*+"|' r"'(?:[^'\\\n]|\\.)*+'|"
                     r"`(?:[^`\\\n]|\\.)*+`", re.DOTALL)
_BARE = re.compile(r"""[^\s"'`,;#{}()\[\]<>|&=:+]++(?:\+[^\s"'`,;#{}()\[\]<>|&=:+]++)*+={0,2}""")
_BLANKS = re.compile(r"[ \t]*+")
_PLUS = re.compile(r"[ \t]*+\+[ \t]*+|[ \t]++(?=[\"'])")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-$")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLACEHOLDER = re.compile(r"\$\{|\{\{|<|%\(|\bexample\b|changeme|change_me|your[_-]|placeholder|dummy|xxxx|\*\*\*|todo|redacted|\.\.\.",
                          re.IGNORECASE)

# Words of names that hold secrets, and words that say the value is something else.
SENSITIVE = {"password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "apikey": 3.0, "credential": 2.5,
             "credentials": 2.5, "token": 2.5, "bearer": 2.0, "auth": 1.5, "authorization": 2.0, "private": 1.5, "signing": 1.0,
             "encryption": 1.0, "access": 1.0, "client": 0.5, "key": 1.5, "api": 1.0, "salt": 1.5, "pin": 1.0}
HARMLESS = {"count": 3.0, "length": 3.0, "len": 3.0, "size": 3.0, "max": 2.0, "min": 2.0, "name": 2.0, "field": 2.5, "file": 2.0,
            "path": 2.0, "url": 2.0, "uri": 2.0, "id": 1.5, "type": 2.5, "label": 2.5, "hint": 2.5, "public": 2.5, "policy": 2.5,
            "expiry": 2.5, "expires": 2.5, "ttl": 2.5, "limit": 2.0, "index": 2.0, "header": 1.5, "regex": 2.5, "format": 2.5}
#: Score from which a literal counts as a secret.
THRESHOLD = 4.0
#: Characters kept of both ends of a value: the longest placeholder less one, so that none is missed where parts meet.
ENDS = 10


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def name_score(name: str) -> float:
    words = [w.lower() for w in _CAMEL.findall(name)]
    words += [a + b for a, b in zip(words, words[1:])]
    return sum(SENSITIVE.get(w, 0.0) for w in words) - sum(HARMLESS.get(w, 0.0) for w in words)


class Value:
    """A literal, or a sum of literals: where it stands and what its score needs.

    ``through`` says that it came through another name.  A part that reads as a placeholder makes the whole one.
    """
    __slots__ = ("span", "parts", "quoted", "through", "length", "head", "tail", "reported", "_text", "_counts", "_placeholder")

    def __init__(self, text: str, span: tuple[int, int], quoted: bool) -> None:
        self.span, self.parts, self.quoted, self.through = span, (), quoted, False
        self.length, self.head, self.tail = len(text), text[:ENDS], text[-ENDS:]
        self.reported: set[str] = set()
        self._text, self._counts, self._placeholder = text, None, None

    @classmethod
    def of(cls, parts: tuple[Value, ...], quoted: bool, through: bool) -> Value:
        self = cls("", parts[-1].span, quoted)
        self.parts, self.through, self._text = parts, through, None
        self.length = sum(p.length for p in parts)
        if len(parts) == 1:
            only = parts[0]
            self.head, self.tail, self._counts, self._placeholder = only.head, only.tail, only.counts, only.placeholder
            return self
        counts, found = Counter(), False
        for part in parts:
            counts.update(part.counts)
            found = found or part.placeholder or bool(_PLACEHOLDER.search(self.tail + part.head))
            self.head, self.tail = (self.head + part.head)[:ENDS], (self.tail + part.tail)[-ENDS:]
        self._counts, self._placeholder = counts, found
        return self

    @property
    def counts(self) -> Counter:
        if self._counts is None:
            self._counts = Counter(self._text)
        return self._counts

    @property
    def placeholder(self) -> bool:
        if self._placeholder is None:
            self._placeholder = bool(_PLACEHOLDER.search(self._text))
        return self._placeholder

    def report(self, kind: str) -> Iterator[Span]:
        """Spans of the parts that were not reported as this kind before."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if kind in value.reported:
                continue
            value.reported.add(kind)
            if value.parts:
                waiting.extend(value.parts)
            elif value.span[1] > value.span[0]:
                yield (kind, *value.span)


def literal_score(value: Value) -> float:
    """How much a literal looks like a secret; minus infinity for what cannot be one."""
    if value.length < 8 or value.placeholder or any(c.isspace() for c in value.counts):
        return -math.inf
    counts = value.counts
    entropy = -sum(n / value.length * math.log2(n / value.length) for n in counts.values())
    classes = sum((any(c.islower() for c in counts), any(c.isupper() for c in counts), any(c.isdigit() for c in counts),
                   any(not c.isalnum() for c in counts)))
    if not value.quoted and (not any(c.isdigit() for c in counts) or classes < 2):
        return -math.inf
    return 0.6 * entropy + 0.4 * classes + min(value.length, 40) / 40 - (0.5 if len(counts) < 5 else 0)


def _back(text: str, at: int, floor: int) -> tuple[int, int]:
    """Start and end of the name before an operator; equal if there is none."""
    while at > floor and text[at - 1] in " \t":
        at -= 1
    if at > floor and text[at - 1] in "\"'`])":
        at -= 1
        if at > floor and text[at - 1] in "\"'`":
            at -= 1
    end = at
    while at > floor and text[at - 1] in _NAME:
        at -= 1
    while at < end and not (text[at].isalpha() or text[at] in "_$"):
        at += 1
    return at, end


def _value(text: str, at: int, known: dict[str, Value]) -> tuple[Value | None, int]:
    """The literal after an operator (sums joined, known names replaced) and where it ends."""
    parts: list[Value] = []
    through = False
    at = _BLANKS.match(text, at).end()
    while True:
        if m := _STRING.match(text, at):
            quote = 3 if m.end() - m.start() >= 6 and text[m.start():m.start() + 3] in ('"""', "'''") else 1
            start, end = m.start() + quote, m.end() - quote
            parts.append(Value(text[start:end], (start, end), True))
        elif m := _BARE.match(text, at):
            old = known.get(m.group().lower())
            through = through or old is not None
            parts.append(old or Value(m.group(), m.span(), False))
        else:
            break
        at = m.end()
        if not (more := _PLUS.match(text, at)):
            break
        if not _STRING.match(text, more.end()) and text[more.end():more.end() + 1] == "":
            break
        if not parts[-1].quoted and "+" not in more.group():
            break
        at = more.end()
    if not parts:
        return None, at
    if len(parts) == 1 and parts[0].through == through:
        return parts[0], at
    return Value.of(tuple(parts), any(p.quoted for p in parts), through), at


def lexed_spans(text: str) -> list[Span]:
    """Literals of sensitive names, directly assigned or through other names."""
    known: dict[str, Value] = {}
    found: list[Span] = []
    floor, typed, waiting = 0, ("", -1), []
    for m in _OPERATOR.finditer(text):
        if m.start() < floor or m.group() in ("!=", "<=", ">=") or m.group().startswith("=="):
            continue
        start, end = _back(text, m.start(), floor)
        if start == end:
            floor = m.end()
            continue
        name = text[start:end]
        if m.group() == "=" and typed[1] == end:  # name: type = literal
            name = typed[0]
        value, after = _value(text, m.end(), known)
        floor = m.end()
        if value is None:
            continue
        if m.group() == ":" and not value.quoted:
            typed = (name, value.span[1])
        if value.quoted:
            floor = after  # operators inside a quoted literal are text
        elif text[after:after + 1] == "=" or _OPERATOR.match(text, _BLANKS.match(text, after).end()):
            waiting.append(name)  # a = b = literal
            continue
        for target in (name, *waiting):
            known[target.lower()] = value
            known[target.lower().rpartition(".")[2]] = value
            sensitive = name_score(target)
            if sensitive >= 1.5 and sensitive + literal_score(value) >= THRESHOLD:
                found += value.report("propagated" if value.through else "literal")
        waiting = []
    return found


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of one whole text; a missing text has none."""
    text = text or ""
    return base_spans(text), lexed_spans(text)


_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long, n_propagated long"


def secrets(documents: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row, repeated rows and rows without id included.

    A missing or empty text has no spans: its digest is that of the empty string.  Other columns are ignored.  Literals and
    sums of any length count.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                base, more = scan(text.as_py())
                count = Counter(s[0] for s in {*base, *more})
                out.append((doc_id, count["assign"], count["access"], count["hex"], digest(joined(base, KINDS)),
                            joined([*base, *more], KINDS), count["literal"], count["propagated"]))
            if out:
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2
                names = [part.split()[0] for part in _RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in zip(kinds, zip(*out))], names)

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(read, _RESULT)
