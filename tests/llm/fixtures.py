"""A small table with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size string, chunk int, row int, "
          "_id long, of string, part int")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source)"""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 8))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, common, base = prose(60), prose(20), prose(120)
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, None, "b"), (2, "", "b"), (3, " \t\n\x0b ", None), (4, "one", "a"), (5, "ONE", "a"), (6, "one two three four", "a"),
        (7, "one two three  four", None), (8, "one two three four", "a"), (None, base, "a"), (None, None, None),
        (9, "x " * 30, "hot"), (10, "x " * 300, "hot"), (11, base, "hot"), (11, base, "hot"), (12, base.upper(), "hot"),
    ]
    for i in range(20, 32):  # near copies, one word changed in each
        changed = base.split()
        changed[rng.randrange(len(changed))] = f"new{i}"
        rows.append((i, " ".join(changed), "hot"))
    for i in range(40, 52):  # a shared passage between own words
        rows.append((i, f"{prose(30)} {passage} {prose(rng.randrange(40))}", "hot" if i % 2 else "c"))
    for i in range(60, 70):  # a common line and own words
        rows.append((i, f"{common}\n{prose(rng.randrange(5, 60))}", "c"))
    rows += [(70, prose(6000), "hot"), (71, "word" * 30000, "hot"), (72, f"{prose(10)} {base} {base}", "d"), (-5, passage, "d")]
    # A chain: neighbours are similar, the ends are not.
    chain = [f"link{j}" for j in range(104)]
    for i in range(4):
        rows.append((80 + i, " ".join([f"c{i}{j}" for j in range(i * 5)] + chain[i * 5:]), None))
    return rows


def documents(spark: SparkSession, rows=None) -> DataFrame:
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), None, "x", 1, 2, 3, "of", 4) for i, t, s in rows], SCHEMA)


def components(rows, width: int = 5, percent: int = 80) -> list[tuple[int | None, int, int | None]]:
    """(doc_id, set size, smallest id reached) by comparing all pairs."""
    sets = []
    for _, text, _ in rows:
        found = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)]
        grams = {tuple(found[i:i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()
        sets.append(grams)
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _, _) in enumerate(rows)]


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
