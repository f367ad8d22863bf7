"""Tokenizer alignment, language model and spelling variants against plain versions, over the awkward and an empty table."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from fixtures import documents, ordered, texts, words

from tutorlake.llm import alignment, kneserney, variants


#: Texts that tokenizers treat in their own ways.
ODD = ["<|endoftext|> <s> </s> <unk>", "a\x00b", "▁x", "  two  blanks ", "tab\tline\n\n\nend", "日本語 ½ ﬁ é é", "😀😀 a", " ", "\n"]


def odd_documents(spark):
    return documents(spark, texts() + [(200 + i, text, "odd") for i, text in enumerate(ODD)])


def odd_rows():
    return texts() + [(200 + i, text, "odd") for i, text in enumerate(ODD)]


# --- tokenizer alignment ------------------------------------------------------


def _walk(a, b, bytes_a, bytes_b):
    """Links and groups by walking both token lists from left to right."""
    links, groups, own_a, own_b, i, j = [], [], [], [], 0, 0
    end_a, end_b = len(bytes_a[0]), len(bytes_b[0])
    while True:
        links.append((a[i], b[j]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            own_a.append(a[i])
        if step_b:
            own_b.append(b[j])
        if step_a and step_b:
            groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
            own_a, own_b = [], []
            if i + 1 == len(a):
                return links, groups
        i, j = i + step_a, j + step_b
        end_a += len(bytes_a[i]) if step_a else 0
        end_b += len(bytes_b[j]) if step_b else 0


def _alignments(rows):
    """Per row the expected measures; the byte side is read with the other public library."""
    from tokenizers import Tokenizer
    byte_side, piece_side = alignment.tokenizers(alignment.FOLDER)
    other = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.BYTE_FILE}")
    other.encode_special_tokens = True
    found, held = [], collections.Counter()
    for _, text, _ in rows:
        found.append(None)
        if text:
            a, b = other.encode(" " + text, add_special_tokens=False).ids, piece_side.coder.encode(text)
            raw, sides = (" " + text).encode(), ([byte_side.bytes_of[x] for x in a], [piece_side.bytes_of[x] for x in b])
            if b"".join(sides[0]) == raw == b"".join(sides[1]):
                found[-1] = (len(a), len(b), *_walk(a, b, *sides))
                held.update(set(found[-1][2]))
    most = collections.Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for (doc_id, _, _), entry in zip(rows, found):
        if entry is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, links, groups = entry
            yield (doc_id, n_a, n_b, len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links),
                   hashlib.sha256(";".join(groups).encode()).hexdigest())


def test_alignment_equals_a_walk_over_both_token_lists(spark):
    found = alignment.alignment_measures(odd_documents(spark)).collect()
    assert ordered(found) == ordered(_alignments(odd_rows()))


def test_alignment_does_not_depend_on_chunks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 2000)
    found = alignment.alignment_measures(odd_documents(spark)).collect()
    assert ordered(found) == ordered(_alignments(odd_rows()))


def test_pair_counts_count_documents(spark):
    rows = [(1, "one two", "a"), (2, "one two", "a"), (3, "one one", "a")]
    pairs = alignment.aligned(documents(spark, rows)).pairs.collect()
    byte_side, _ = alignment.tokenizers(alignment.FOLDER)
    counts = collections.Counter()
    for row in pairs:
        counts[byte_side.bytes_of[row.a]] = max(counts[byte_side.bytes_of[row.a]], row.n)
    assert (counts[b" one"], counts[b" two"]) == (3, 2)


def test_a_text_that_one_library_refuses_goes_to_the_other():
    byte_side, _ = alignment.tokenizers(alignment.FOLDER)
    text, coder = " " + "ab 12\n" * 50, byte_side.coder

    class Refusing:
        def encode_ordinary(self, text):
            raise ValueError("too long")

    expected = byte_side.encode(text)
    byte_side.coder = Refusing()
    try:
        assert byte_side.encode(text) == expected
    finally:
        byte_side.coder = coder


# --- language model -------------------------------------------------------------


def _tokens(text):
    return [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in words(text)] + [None]


def _scores(rows, order):
    """Modified Kneser-Ney by its definition, over dictionaries."""
    def out(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2

    training = [_tokens(text) for doc_id, text, _ in rows if not out(doc_id)]
    single = collections.Counter(w for line in training for w in line)
    n_all, n_types = sum(single.values()), len(single)
    begin = [0] * (order - 1)
    counts = {order: collections.Counter()}
    for line in training:
        line = begin + line
        counts[order].update(tuple(line[i - order + 1:i + 1]) for i in range(order - 1, len(line)))
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(gram[1:] for gram in counts[n + 1])
    discount, context = {}, {}
    for n in counts:
        discount[n] = [0.0, *kneserney._discounts(*[list(counts[n].values()).count(k) for k in (1, 2, 3, 4)])]
        context[n] = collections.defaultdict(lambda: [0, 0, 0, 0])
        for gram, c in counts[n].items():
            context[n][gram[:-1]][0] += c
            context[n][gram[:-1]][min(c, 3)] += 1

    def probability(gram):
        if not gram:
            return 1 / (n_types + 1)
        n, lower = len(gram), probability(gram[1:])
        if gram[:-1] not in context[n]:
            return lower
        total, *follow = context[n][gram[:-1]]
        c, d = counts[n][gram], discount[n]
        return max(c - d[min(c, 3)], 0) / total + sum(d[k] * follow[k - 1] for k in (1, 2, 3)) / total * lower

    for doc_id, text, _ in rows:
        line = _tokens(text)
        padded = begin + line
        yield (doc_id, out(doc_id), len(line), sum(w in single for w in line), n_all,
               round(sum(math.log10((single[w] + 1) / (n_all + n_types + 1)) for w in line), 6),
               round(sum(math.log10(probability(tuple(padded[i:i + order]))) for i in range(len(line))), 6))


def _rounded(found):
    return [(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in found]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_the_definition(spark, order):
    found = kneserney.language_scores(odd_documents(spark), order).collect()
    assert ordered(_rounded(found)) == ordered(_scores(odd_rows(), order))
    assert all(abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) <= 1e-9 * r.perplexity for r in found)


def test_scores_do_not_depend_on_chunks_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(kneserney, "CHUNK_BYTES", 3000)
    found = kneserney.language_scores(odd_documents(spark).repartition(13), 3).collect()
    assert ordered(_rounded(found)) == ordered(_scores(odd_rows(), 3))


def test_probabilities_after_a_context_add_up_to_one(spark):
    rows = [r for r in texts() if r[0] is not None and r[0] < 13]
    trained = kneserney.train(documents(spark, rows).select("text"), 3)
    vocabulary = sorted({w.encode() for _, text, _ in rows for w in _tokens(text) if w is not None})
    hashes = kneserney.word_hashes(vocabulary)
    numbers, counts = kneserney._numbered(trained.folder, trained.starts, trained.bits, hashes)
    assert counts.min() > 0 and len(set(numbers.tolist())) == len(vocabulary)
    told = np.array([False, False, True])
    for before in ([kneserney.BEGIN, kneserney.BEGIN], numbers[:2].tolist(), [kneserney.UNKNOWN, int(numbers[0])]):
        lines = [np.array([*before, last], np.uint64) for last in [*numbers.tolist(), kneserney.END, kneserney.UNKNOWN]]
        assert abs(sum(kneserney._probabilities(trained, line, told)[0] for line in lines) - 1) < 1e-12


def test_a_model_needs_a_mounted_folder():
    assert kneserney.model_folder("file:/a/b") == kneserney.model_folder("file:///a/b") == "/a/b"
    with pytest.raises(ValueError):
        kneserney.model_folder("store://bucket/a")


# --- spelling variants ------------------------------------------------------------


def _variants(rows):
    import re
    counts = collections.Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            check = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and check % 97 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    nears = {w: [v for v in known if near(w, v)] for w in known}
    forms = {}
    for w, others in nears.items():
        best = min(others, key=lambda v: (-known[v], v), default=None)
        forms[w] = best if best is not None and known[best] >= 2 * known[w] else None
    for w, n in known.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        yield w, forms[w], root, n, len(nears[w]), known.get(forms[w])


def _spelled():
    """Words that lead to each other step by step, ties between two forms, letters beyond ASCII, upper case."""
    counts = {"kettle": 40, "kettel": 3, "kettlé": 9, "ketle": 20, "ketlé": 4, "sattle": 16, "settle": 16, "suttle": 8, "ÉCLAIR": 12, "éclair": 12,
              "Éclair": 3, "abcde": 3, "abcdef": 6, "abcdefg": 12, "abcdefgh": 24, "abcdefghi": 48, "abcd": 90, "straße×÷": 5, "strasse": 7, "straße": 3}
    lines = [" ".join([w] * n) for w, n in counts.items()]
    return [(300 + i, line.title() if i % 3 == 0 else line, "w") for i, line in enumerate(lines)]


def test_variants_equal_all_pairs(spark):
    rows = texts() + _spelled()
    found = variants.spelling_variants(documents(spark, rows)).collect()
    assert ordered(found) == ordered(_variants(rows))
    by_word = {r.word: r for r in found}
    assert (by_word["abcde"].form, by_word["abcde"].root) == ("abcdef", "abcdefghi")
    assert by_word["suttle"].form == "sattle"


@pytest.mark.parametrize("word", ["abcé", "aaaa", "a", "xxyyxx", "straße"])
def test_neighbourhoods_hold_every_edit_once(spark, word):
    row = spark.createDataFrame([(word,)], "word string")
    r, symbols = row.select(variants.reduced(variants.F.col("word")).alias("r")).first().r, variants.SYMBOLS
    found = [x.form for x in variants.neighbourhoods(row).collect()]
    expected = {r} | {r[:i] + r[i + 1:] for i in range(len(r))}
    expected |= {r[:i] + s + r[i + 1:] for i in range(len(r)) for s in symbols} | {r[:i] + s + r[i:] for i in range(len(r) + 1) for s in symbols}
    assert sorted(found) == sorted(expected)


# --- empty tables and columns with clashing names ---------------------------------


def test_empty_tables(spark):
    none = documents(spark, [])
    assert alignment.alignment_measures(none).count() == 0
    assert kneserney.language_scores(none).count() == 0
    assert variants.spelling_variants(none).count() == 0


def test_nothing_to_learn_from(spark):
    held = [(i, "some words", "a") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = kneserney.language_scores(documents(spark, held)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {(3, 0, 0, 0.0, 0.0)}


def test_tables_of_texts_without_words(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, " ", None), (4, "...", "a")]
    assert len(alignment.alignment_measures(documents(spark, rows)).collect()) == 4
    assert ordered(_rounded(kneserney.language_scores(documents(spark, rows), 3).collect())) == ordered(_scores(rows, 3))
    assert variants.spelling_variants(documents(spark, rows)).count() == 0


def test_columns_with_clashing_names(spark):
    extra = {name: variants.F.lit("x") for name in ("digest", "copies", "pair", "n", "held_out", "run", "word", "check", "chunk", "body")}
    wide = documents(spark, _spelled()).withColumns(extra)
    plain = documents(spark, _spelled())
    for operator in (alignment.alignment_measures, kneserney.language_scores, variants.spelling_variants):
        assert ordered(operator(wide).collect()) == ordered(operator(plain).collect())
