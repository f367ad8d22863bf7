"""Spelling variants: words one edit apart, found through a reduced alphabet.

Every letter is hashed to one of a few symbols, so that the whole one-edit neighbourhood of a word is a short list of
reduced words: about ``2 * SYMBOLS`` per letter, whatever the alphabet.  The neighbourhood is generated for each word and
joined with the reduced vocabulary; the pairs that meet are verified on the original strings.  One edit of a word is at
most one edit of its reduced form, so no pair is missed, and a pair meets once because neighbourhoods are sets.

Most reduced neighbours are nobody's reduced word.  A bit table of fixed size (``BITS``, so its broadcast has a bound)
says which can be: it is a bitmap aggregate of the reduced vocabulary, and only neighbours whose bit is set are shuffled.
When a vocabulary outgrows the table more neighbours travel, and the result stays the same.

Defined cases: a NULL or empty text has no words; repeated rows count each time; ties of the form go to the smaller word in
code-point order; a vocabulary without near words has no forms; an empty table gives an empty result.  Other columns of
the input are never read.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.session import stored

#: Letters of a word, and the symbols that they are hashed to.
LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS = "01234567"
#: Words count from this length and number of occurrences on.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least this many times as often as the word.
RATIO = 2
#: Bits of the table of reduced words, 8 MB of them, and the bits of one bucket, which the bitmap functions fix.
BITS, BUCKET = 1 << 26, 1 << 15

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_runs(docs: DataFrame, run: str = "run") -> DataFrame:
    """One row per maximal run of letters of every text, A-Z in lower case, with the document's ``doc_id``."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]+"), F.lit(0))).alias(run))
    return runs.withColumn(run, F.translate(run, _UPPER, _LOWER))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``, its occurrences, of the words long and frequent enough."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def reduced(word: Column) -> Column:
    """The word with every letter replaced by its symbol; characters that are no letters stay."""
    letters = _LOWER + _UPPER + "".join(map(chr, range(0xC0, 0x100)))
    return F.translate(word, letters, "".join(SYMBOLS[zlib.crc32(c.encode()) % len(SYMBOLS)] for c in letters))


def neighbourhoods(words: DataFrame, form: str = "form") -> DataFrame:
    """``word`` and ``form``: all reduced words within one edit of the reduced word, itself included, each once.

    Every place of a word is met by every symbol, which is inserted before the place or replaces what stands there; without
    a symbol the place is deleted.  Edits with the same outcome are told apart by place: a symbol is inserted behind its
    like, and of a run the first place is deleted.
    """
    none = F.lit("")
    edits = F.array(*[F.struct(F.lit(s).alias("put"), F.lit(drop).alias("drop")) for s in ("", *SYMBOLS) for drop in (False, True)])
    places = words.select("word", reduced(F.col("word")).alias("whole"), F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    cut = places.select("word", "at", F.substr("whole", F.lit(1), F.col("at")).alias("head"),
                        F.substr("whole", F.col("at") + 1, F.lit(1)).alias("here"), F.substr("whole", F.col("at") + 2).alias("rest"),
                        F.substr("whole", F.col("at"), F.least("at", F.lit(1))).alias("last"))
    edit = cut.select("*", F.explode(edits).alias("edit")).select("word", "at", "head", "here", "rest", "last", "edit.put", "edit.drop")
    put, here = F.col("put"), F.col("here")
    whole = (put == none) & ~F.col("drop") & (F.col("at") == 0)
    deleted = (put == none) & F.col("drop") & (here != none) & (here != F.col("last"))
    placed = (put != none) & (put != here) & (~F.col("drop") | (here != none))
    outcome = F.concat("head", put, F.when(F.col("drop"), none).otherwise(here), "rest")
    return edit.filter(whole | deleted | placed).select("word", outcome.alias(form))


def _bit_of(form: Column) -> Column:
    return F.pmod(F.xxhash64(form), F.lit(BITS))


def _bit_table(forms: DataFrame) -> DataFrame:
    """``bucket`` and ``numbers``: the bits of all forms, 32 in a number, a fixed count of numbers in a bucket."""
    marked = forms.select(_bit_of(F.col("form")).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    four = F.transform(F.sequence(F.lit(0), F.lit(BUCKET // 32 - 1)), lambda i: F.conv(
        F.hex(F.substr("bitmap", i * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    return marked.select("bucket", four.alias("numbers"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: every ordered pair of words that differ by exactly one edit."""
    forms = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), reduced(F.col("word")).alias("form"))
    asked = neighbourhoods(words).withColumn("bit", _bit_of(F.col("form"))).withColumn("bucket", F.bitmap_bucket_number("bit"))
    at = F.bitmap_bit_position("bit").cast("int")
    # Of a number's four bytes the first is the highest.
    number, place = F.get("numbers", F.shiftright(at, 5)), (3 - F.shiftright(at, 3) % 4) * 8 + at % 8
    asked = asked.join(F.broadcast(_bit_table(forms)), "bucket")
    known = asked.filter(F.getbit(number, place) == 1).select("word", "form")
    met = known.join(forms, "form").filter(F.col("word") != F.col("near"))
    return met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(forms: DataFrame, label: str = "variant-roots") -> DataFrame:
    """``word`` and ``root``, where following ``form`` from ``word`` ends.

    Each round doubles the steps taken.  A form occurs ``RATIO`` times as often as its word, so paths are short and
    hold no cycle.  Rounds are stored, which cuts the lineage.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), label)
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(ahead, "root", "left"), label)
        at = moved.select("word", F.coalesce("next", "root").alias("root"))
        if not moved.filter(F.col("next").isNotNull()).limit(1).count():
            return at


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of a vocabulary of ``word`` and ``n``.

    ``form`` is the most frequent word one edit away, if it occurs at least ``ratio`` times as often; ``root`` is where
    the forms lead, the word itself if it has none.
    """
    words = stored(words.select("word", "n"), "variant-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    found = stored(known.select(
        "word", F.when(has_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "variants")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_typos(docs: DataFrame, every: int = 97) -> DataFrame:
    """``word``: the runs of all texts, where those whose checksum with the document's id is divisible lose one letter.

    Runs of rows without an id stay as they are.
    """
    runs = lowered_runs(docs).filter(F.length("run") >= LEAST_LENGTH)
    check = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("check") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return runs.withColumn("check", check).select(
        F.when(F.col("check") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variant groups of the words of all texts, with planted deletions."""
    return variant_groups(vocabulary(with_typos(docs)))
