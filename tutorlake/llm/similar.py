"""N-gram Jaccard join: candidates must share prefix tokens under several global token orders.

A document's set holds its distinct word n-grams.  If two sets reach the threshold, then under any order of all tokens
the first ``n - ceil(t * n) + 1`` tokens of both have one in common.  All orders here put rare tokens first (classes of
exact document frequency, from the packed exchange) and differ inside a class.  Tokens that only one chunk of documents
knows cannot be shared and are never shipped, so most documents send nothing.

A posting carries how many tokens of its document come from there on: if a token is the first that two documents
share, their intersection is no larger, so pairs that cannot reach the threshold are not formed.

Within a token, documents are first compared with one leader only, the one with the fewest tokens of its own, so that
a group of many copies costs a line and not a square.  Found links are joined to components; then every pair of one
token whose components still differ is a candidate, so no link between components is lost.  Candidates of the first
order pass the prefix filters of the other orders before their full sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.llm import exchange
from tutorlake.llm.common import components, mix, scanned, window_hashes, word_hashes, words_of
from tutorlake.session import stored

#: Shingle width and similarity in percent.
WIDTH, PERCENT = 5, 80
#: Salts of the token orders; the first generates candidates, the others filter them.
ORDERS = (101, 202, 303)
#: Bits of a token that frequency is counted by; a rare collision only moves a token to a more frequent class.
COUNT_BITS = 40


def token_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Ascending hashes of the distinct n-grams of the lower-cased (A-Z) words; a short text is one n-gram."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        # No n-gram of `width` words hashes like a shorter sequence: the length is part of the text hashed.
        return np.array([xxhash.xxh3_64_intdigest(b"%d\0" % len(words) + b" ".join(words))], np.uint64)
    return np.unique(window_hashes(word_hashes(words), width))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _counted(tokens: np.ndarray) -> np.ndarray:
    """The bits that frequencies are counted by, as leading bits so that ranges stay even."""
    return tokens >> np.uint64(64 - COUNT_BITS) << np.uint64(64 - COUNT_BITS)


def _announce(width: int):
    def announce(rows: list[tuple]):
        held = [np.unique(_counted(token_set(row[-1], width))) for row in rows]
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64),) * 2
        return tokens, counts.astype(np.uint64), None
    return announce


def _frequency_class(tokens: np.ndarray, owner: np.ndarray, counts: np.ndarray, extra: list) -> np.ndarray:
    """0 for a token of one document, else the bit length of its document frequency."""
    _, at = np.unique(tokens, return_inverse=True)
    total = np.bincount(at, weights=counts.astype(np.float64))[at]
    return np.where(total <= 1, 0, np.floor(np.log2(np.maximum(total, 1))) + 1)


def _prefixes(tokens: np.ndarray, classes: np.ndarray, percent: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The shared tokens of each order's prefix, and how many tokens there are from each of the first order's on."""
    size = prefix_length(len(tokens), percent)
    out = []
    for salt in ORDERS:
        scrambled = mix(tokens, salt)
        first = np.lexsort((scrambled, classes))[:size]
        out.append(tokens[first][classes[first] > 0])
    # Tokens of one document alone come before all others.
    alone = size - len(out[0])
    return out, len(tokens) - np.arange(alone, size)


_PREPARED = ("doc_id long, n long, cid long, posts array<long>, rests array<long>, own long, marks binary, packed binary")
_MARK = np.dtype("<u4")


def _prepare(width: int, percent: int):
    def build(chunk: int, rows: list[tuple], flags: np.ndarray) -> pa.Table:
        held = [token_set(row[-1], width) for row in rows]
        known = np.unique(np.concatenate([_counted(s) for s in held])) if held else np.empty(0, np.uint64)
        exchange.expect(flags, known)
        squeeze, seen, out = zstandard.ZstdCompressor(level=3), set(), []
        for (doc_id, text), tokens in zip(rows, held):
            posts = rests = own = marks = packed = None
            cid = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes())[:8], "<i8")[0].item()
            if len(tokens) and cid not in seen:
                seen.add(cid)
                classes = flags[np.searchsorted(known, _counted(tokens))]
                (first, *others), left = _prefixes(tokens, classes, percent)
                # A prefix without a shared token in any order rules out every partner.
                if len(first) and all(map(len, others)):
                    posts, rests, own = first.view(np.int64).tolist(), left.tolist(), int(np.count_nonzero(classes == 0))
                    short = [np.unique(p.astype(_MARK)) for p in others]
                    marks = np.array(list(map(len, short)), "<u4").tobytes() + b"".join(s.tobytes() for s in short)
                    packed = squeeze.compress((text or "").encode("utf-8", "surrogatepass"))
            out.append((doc_id, len(tokens), cid, posts, rests, own, marks, packed))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary())
        names = ("doc_id", "n", "cid", "posts", "rests", "own", "marks", "packed")
        return pa.table({k: pa.array(c, t) for k, t, c in zip(names, kinds, zip(*out))})
    return build


def _shares_marks(a: bytes, b: bytes) -> bool:
    """Whether both sets share a prefix token under every further order (by 32 bits: may err towards yes only)."""
    n = len(ORDERS) - 1
    sizes_a, sizes_b = np.frombuffer(a, "<u4", n), np.frombuffer(b, "<u4", n)
    at_a = at_b = 4 * n
    for x, y in zip(sizes_a, sizes_b):
        left, right = np.frombuffer(a, _MARK, x, at_a), np.frombuffer(b, _MARK, y, at_b)
        if not np.isin(left, right, assume_unique=True).any():
            return False
        at_a, at_b = at_a + 4 * int(x), at_b + 4 * int(y)
    return True


def _filter_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("marks_a"), batch.column("marks_b")
        keep = pa.array([_shares_marks(x.as_py(), y.as_py()) for x, y in zip(left, right)], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _verify(width: int, percent: int):
    def unpacked(blob: bytes, cache: dict) -> np.ndarray:
        if blob not in cache:
            if len(cache) > 64:
                cache.clear()
            raw = zstandard.ZstdDecompressor().decompress(blob)
            cache[blob] = token_set(raw.decode("utf-8", "surrogatepass"), width)
        return cache[blob]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, np.ndarray] = {}
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("packed_a"), batch.column("packed_b")):
                left, right = unpacked(x.as_py(), cache), unpacked(y.as_py(), cache)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * shared >= percent * (len(left) + len(right) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return verify


def _linked(pairs: DataFrame, sets: DataFrame, width: int, percent: int, label: str) -> DataFrame:
    """The candidate pairs that pass the further orders and then the comparison of their sets."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sides = stored(sets.join(needed, "cid", "left_semi").groupBy("cid").agg(
        F.min(F.struct("marks", "packed")).alias("s")).select("cid", "s.marks", "s.packed"), f"{label}-sides")

    def side(column: str, end: str) -> DataFrame:
        return sides.select(F.col("cid").alias(end), F.col(column).alias(f"{column}_{end}"))

    likely = (pairs.join(side("marks", "a"), "a").join(side("marks", "b"), "b")
              .select("a", "b", "marks_a", "marks_b").mapInArrow(_filter_marks, "a long, b long"))
    likely = stored(likely, f"{label}-likely")
    return (likely.join(side("packed", "a"), "a").join(side("packed", "b"), "b")
            .select("a", "b", "packed_a", "packed_b").mapInArrow(_verify(width, percent), "a long, b long"))


def _fits(percent: int) -> Column:
    """Whether sizes and what is left of both documents from the shared token on allow the similarity."""
    sizes = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    return sizes & ((100 + percent) * F.least("rx", "ry") >= percent * (F.col("nx") + F.col("ny")))


def _side(posts: DataFrame, end: str, *more: Column) -> DataFrame:
    return posts.select("token", F.col("cid").alias(end), F.col("n").alias(f"n{end}"), F.col("rest").alias(f"r{end}"), *more)


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs of the rows' ``x`` and ``y``, the smaller first."""
    return rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similarity_classes(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                       keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row.

    Two rows are linked when ``100 * intersection >= percent * union`` of their sets of ``width``-word shingles
    (a shorter text is one shingle of all its words).  ``component_id`` is the smallest doc_id that links reach.
    Rows with equal sets are linked, repeated rows included; a missing or empty text has 0 shingles, no link and its own
    doc_id.  A missing doc_id takes part, but never is a component's smallest.  Other columns are ignored.
    """
    docs = scanned(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                   "similar-docs")
    flags = exchange.answers(docs, _announce(width), _frequency_class, exchange.range_count(docs))
    prepared = stored(exchange.with_answers(docs, flags, _prepare(width, percent), _PREPARED), "similar-sets")
    sets = prepared.filter("posts IS NOT NULL").select("cid", "marks", "packed")
    posts = prepared.filter("posts IS NOT NULL").select("cid", "n", "own", F.explode(F.arrays_zip("posts", "rests")).alias("p"))
    posts = stored(posts.select(F.col("p.posts").alias("token"), "cid", "n", "own", F.col("p.rests").alias("rest")).distinct(),
                   "similar-posts")

    # Comparison with one leader per token.
    lead = posts.groupBy("token").agg(F.min(F.struct("own", "cid", "n", "rest")).alias("low"), F.count(F.lit(1)).alias("held"))
    lead = stored(lead.filter("held > 1").select("token", F.col("low.cid").alias("y"), F.col("low.n").alias("ny"),
                                                 F.col("low.rest").alias("ry")), "similar-lead")
    shared = stored(posts.join(lead, "token"), "similar-shared")
    tried = _side(shared, "x", F.col("y"), F.col("ny"), F.col("ry")).filter((F.col("x") != F.col("y")) & _fits(percent))
    tried = stored(_pairs(tried), "similar-tried")
    links = stored(_linked(tried, sets, width, percent, "similar-1"), "similar-links")
    labels = components(links, "similar-first")

    # Pairs of one token whose components still differ.
    named = stored(shared.select("token", "cid", "n", "rest").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
                   .withColumn("component", F.coalesce("component", "cid")), "similar-named")
    mixed = stored(named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo <> hi").select("token"), "similar-mixed")
    open_posts = stored(named.join(mixed, "token"), "similar-open")
    left = _side(open_posts, "x", F.col("component").alias("cx"))
    right = _side(open_posts, "y", F.col("component").alias("cy"))
    rest = left.join(right, (left["token"] == right["token"]) & (F.col("cx") < F.col("cy")) & _fits(percent))
    rest = stored(_pairs(rest).join(tried, ["a", "b"], "left_anti"), "similar-rest")
    more = stored(_linked(rest, sets, width, percent, "similar-2"), "similar-more")
    labels = components(links.union(more), "similar-last")

    classed = prepared.select("doc_id", "n", "cid").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
    classed = stored(classed.select("doc_id", "n", F.coalesce("component", "cid").alias("label")), "similar-classed")
    least = stored(classed.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "similar-least")
    return (classed.filter("n > 0").join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
            .union(classed.filter("n = 0").select("doc_id", "n", "doc_id")))
