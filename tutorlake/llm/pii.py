"""Personal data by weak supervision.

Candidate spans come from broad patterns: the four base kinds and further kinds (numbers written locally, national
ids, bank accounts, spelled-out addresses, named persons).  Labelers look at each candidate and vote for, against or not
at all: a strict form check, a gazetteer, the words before it, the characters around it, the variety of its
characters.  How often each combination of votes occurs is counted over all documents; expectation-maximisation on
those counts (their number is bounded by kinds x 3 ^ labelers x lengths) estimates each labeler's reliability and
each combination's probability.  These train the final classifier of spans, a logistic regression over votes, kind and
length.  Base spans always stay; candidates of further kinds are added where the classifier says so.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tutorlake.llm.spans import Span, digest, joined
from tutorlake.session import stored

#: Kinds in their order; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local_phone", "national_id", "iban", "spelled_email", "person")
LABELERS = ("form", "gazetteer", "context", "surroundings", "variety")
#: Probability from which the classifier adds a span; steps of expectation-maximisation and of training.
ADDED, ROUNDS, STEPS = 0.5, 60, 400

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MORE = {
    "local_phone": re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    "national_id": re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "spelled_email": re.compile(r"(?<!\w)[A-Za-z0-9._-]{2,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{2,64} ?[\[(](?:dot|DOT)[\])] ?[A-Za-z]{2,24}(?!\w)"),
    "person": re.compile(r"(?:(?<=Mr\. )|(?<=Mrs\. )|(?<=Ms\. )|(?<=Dr\. )|(?<=my name is )|(?<=My name is )|(?<=Sincerely, ))"
                         r"[A-Z][a-z]+(?: [A-Z][a-z]+){0,2}"),
}

# Common top-level domains, words that announce personal data and words that announce other numbers, first names.
DOMAINS = frozenset(("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "ch", "at", "it", "nl", "example"))
FOR = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address", "reach"),
    "ip": ("ip", "host", "address", "server", "from", "client"),
    "card": ("card", "credit", "visa", "mastercard", "amex", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "contact"),
    "national_id": ("ssn", "social", "security", "national", "id"),
    "iban": ("iban", "account", "bank", "transfer"),
    "person": ("name", "sincerely", "mr", "mrs", "ms", "dr"),
}
AGAINST = ("order", "invoice", "version", "isbn", "issn", "build", "page", "ref", "reference", "ticket", "section", "chapter", "figure")
FIRST_NAMES = frozenset((
    "alice", "anna", "bob", "carlos", "charlie", "david", "emily", "emma", "eva", "frank", "george", "grace", "hannah", "henry",
    "jack", "james", "jane", "jim", "john", "julia", "kate", "laura", "linda", "lisa", "lucas", "lucy", "maria", "mark", "mary",
    "mia", "mike", "nina", "oliver", "paul", "peter", "robert", "sam", "sarah", "sofia", "susan", "tim", "tom"))
#: Characters before a candidate that the context labeler reads.
CONTEXT = 40
_LETTERS = re.compile(r"[a-z]+")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """From each domain back over the local part, so that long runs of letters are read once."""
    floor = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield "email", start, m.end()
            floor = m.end()


def base_spans(text: str) -> list[Span]:
    found = list(_emails(text))
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return found


def candidates(text: str, base: Sequence[Span]) -> list[Span]:
    """Spans of the further kinds that touch no base span and no earlier candidate."""
    taken = sorted((a, b) for _, a, b in base)
    found: list[Span] = []
    for kind in KINDS[len(BASE):]:
        at, fresh = 0, []
        for m in _MORE[kind].finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at == len(taken) or taken[at][0] >= m.end():
                fresh.append((kind, m.start(), m.end()))
        found += fresh
        taken = sorted([*taken, *((a, b) for _, a, b in fresh)])
    return found


def _iban_holds(value: str) -> bool:
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def votes(text: str, span: Span) -> tuple[int, ...]:
    """1 for, -1 against, 0 no vote; one per labeler."""
    kind, start, end = span
    value = text[start:end]
    digits = _digits(value)
    if kind == "card":
        form = 1 if digits[0] in "3456" else 0
    elif kind == "iban":
        form = 1 if _iban_holds(value) else -1
    elif kind == "local_phone":
        form = 1 if digits[0] not in "01" and digits[3] not in "01" else -1
    elif kind == "national_id":
        form = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    elif kind == "ip":
        form = -1 if any(len(p) > 1 and p[0] == "0" for p in value.split(".")) else 1
    else:
        form = 1
    if kind in ("email", "spelled_email"):
        gazetteer = 1 if value.lower().rpartition("." if kind == "email" else " ")[2].strip("[]() ") in DOMAINS else 0
    elif kind == "person":
        gazetteer = 1 if any(w.lower() in FIRST_NAMES for w in value.split()) else 0
    elif kind == "ip":
        gazetteer = -1 if value.startswith(("0.", "255.")) or value == "127.0.0.1" else 1
    else:
        gazetteer = 0
    before = set(_LETTERS.findall(text[max(0, start - CONTEXT):start].lower()))
    known = FOR.get({"local_phone": "phone", "spelled_email": "email"}.get(kind, kind), ())
    context = 1 if before.intersection(known) else -1 if before.intersection(AGAINST) else 0
    left, right = text[start - 1:start], text[end:end + 1]
    inside = (left.isalnum() or left in "_/=") if left else False
    surroundings = -1 if inside or (right.isalnum() or right == "_") else 1
    different = len(set(digits or value.lower()))
    variety = -1 if different <= 2 else 1 if different >= 4 else 0
    return form, gazetteer, context, surroundings, variety


def _key(kind: str, cast: tuple[int, ...], length: int) -> int:
    """Kind, votes and length class as one small number."""
    key = KINDS.index(kind)
    for vote in cast:
        key = key * 3 + vote + 1
    return key * 4 + min(3, length // 8)


def _unkey(key: int) -> tuple[int, list[int], int]:
    key, length = divmod(key, 4)
    cast = []
    for _ in LABELERS:
        key, vote = divmod(key, 3)
        cast.append(vote)
    return key, cast[::-1], length


def reliabilities(kinds: np.ndarray, cast: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each vote of each labeler in both classes, and the probability that each combination is personal data."""
    lean = (cast == 2).sum(1) - 1.5 * (cast == 0).sum(1)
    positive = 1 / (1 + np.exp(-lean))
    for _ in range(ROUNDS):
        tables = np.empty((len(LABELERS), 2, 3))
        for j in range(len(LABELERS)):
            for z, share in enumerate((1 - positive, positive)):
                # The added votes keep empty cells from 0 and hold the meaning of the classes where there are few candidates.
                prior = np.array((4.0, 2.0, 1.0) if z == 0 else (1.0, 2.0, 4.0))
                tables[j, z] = np.bincount(cast[:, j], counts * share, 3) + prior
            tables[j] /= tables[j].sum(1, keepdims=True)
        score = np.zeros((len(kinds), 2))
        for z, share in enumerate((1 - positive, positive)):
            of_kind = np.bincount(kinds, counts * share, len(KINDS)) + 1
            score[:, z] = np.log(of_kind)[kinds] + sum(np.log(tables[j, z])[cast[:, j]] for j in range(len(LABELERS)))
        positive = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return tables, positive


def _design(kinds: np.ndarray, cast: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    blocks = [np.eye(len(KINDS))[kinds], np.eye(4)[lengths], *(np.eye(3)[cast[:, j]] for j in range(len(LABELERS)))]
    return np.concatenate(blocks, axis=1)


def train(rows: Sequence[Row]) -> dict[int, float]:
    """The classifier's probability for every combination seen, from (key, n) counts."""
    if not rows:
        return {}
    parts = [_unkey(r["key"]) for r in rows]
    kinds, cast, lengths = (np.array(x) for x in zip(*parts))
    counts = np.array([r["n"] for r in rows], float)
    _, target = reliabilities(kinds, cast, counts)
    # Counts and ridge over one common number: the same fit, with sums near 1 however large the corpus.
    inputs, weight, ridge = _design(kinds, cast, lengths), counts / counts.sum(), 0.1 / counts.sum()
    beta = np.zeros(inputs.shape[1])
    for _ in range(STEPS // 20):  # Newton steps with a ridge
        guess = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        slope = inputs.T @ (weight * (guess - target)) + ridge * beta
        curve = (inputs * (weight * guess * (1 - guess))[:, None]).T @ inputs + ridge * np.eye(len(beta))
        beta -= np.clip(np.linalg.solve(curve, slope), -3, 3)
    sure = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
    return {int(r["key"]): float(p) for r, p in zip(rows, sure)}


_FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
          "more array<string>, keys array<int>, base_keys array<int>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in _FOUND.split(", ")]
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            base = base_spans(text)
            more = candidates(text, base)
            count = Counter(s[0] for s in base)
            out.append((doc_id, *(count[k] for k in BASE), joined(base, KINDS), [joined([s], KINDS) for s in more],
                        [_key(s[0], votes(text, s), s[2] - s[1]) for s in more],
                        [_key(s[0], votes(text, s), s[2] - s[1]) for s in base]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in zip(kinds, zip(*out))], names)


_RESULT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def personal_data(documents: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row, repeated rows and rows without id included.

    A missing or empty text has no spans: its digest is that of the empty string.  Other columns are ignored.
    """
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(narrow.mapInArrow(_scan, _FOUND), "pii-found")
    seen = found.select(F.explode(F.concat("keys", "base_keys")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # At most len(KINDS) * 3 ** len(LABELERS) * 4 rows.
    sure = documents.sparkSession.sparkContext.broadcast(train(sorted(seen.collect(), key=lambda r: r["key"])))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance, names = sure.value, [part.split()[0] for part in _RESULT.split(", ")]
        for batch in batches:
            texts, digests, added = [], [], []
            for base, more, keys in zip(*(batch.column(c).to_pylist() for c in ("base", "more", "keys"))):
                new = [s for s, k in zip(more, keys) if chance[k] >= ADDED]
                spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in [*filter(None, base.split(",")), *new])]
                texts.append(joined(spans, KINDS))
                digests.append(digest(base))
                added.append(len(new))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:5]), pa.array(digests, pa.string()), pa.array(texts, pa.string()),
                 pa.array(added, pa.int64())], names)

    return found.mapInArrow(decide, _RESULT)
