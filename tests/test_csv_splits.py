"""Quoted CSV files that are read by splits give what reading them whole gives."""

import contextlib
import random

import pytest
from pyspark.sql import functions as F

from tutorlake.sources import csvfiles


@contextlib.contextmanager
def small_splits(spark, size):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (str(size), "1")):
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in zip(names, kept):
            spark.conf.set(name, value)


def cell(rng):
    plain = rng.choice(["", "a", "x y", "é", "1 2", "plain", ' lead', 'mid"dle', "it's"])
    inner = "".join(rng.choice(['a', ',', '\n', '""', 'é', ' ', '\r\n', '\n\n', '"",""', "long" * 8]) for _ in range(rng.randrange(6)))
    return rng.choice([plain, plain, f'"{inner}"'])


def written(rng, rows):
    return "".join(f"{n}," + ",".join(cell(rng) for _ in range(rng.choice([3, 3, 3, 2]))) + rng.choice(["\n", "\n", "\n\n", "\r\n"]) for n in range(rows))


@pytest.mark.parametrize("seed, size", [(1, 64), (2, 200), (3, 1 << 20), (4, 16), (5, 37)])
def test_splits_give_the_records_of_the_whole_file(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes(("n,one,\"two\nlines\",three\n" + written(rng, 60)).encode())
    whole = [row for name in ("a.csv", "b.csv") for row in spark.read.schema("c0 string, c1 string, c2 string, c3 string").csv(
        str(tmp_path / name), header=True, multiLine=True, quote='"', escape='"', lineSep="\n").collect()]
    with small_splits(spark, size):
        header, found = csvfiles._records(spark, str(tmp_path), 0, True)
        assert size > 1000 or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        rows = found.orderBy("source_row").collect()
    assert header == ["n", "one", "two\nlines", "three"]
    assert [r.source_row for r in rows] == list(range(len(rows)))

    def plain(value):  # the whole reading leaves carriage returns at line ends to the last cell
        return None if value is None else value.removesuffix("\r") or None

    assert [tuple(map(plain, tuple(r)[:4])) for r in rows] == [tuple(map(plain, r)) for r in whole]


def test_a_quote_that_never_closes_takes_the_rest_of_its_file_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,x\n2,"open\n3,y\n' + "4,zzzzzzzzzzzzzzzzzzzzzzzzzzz\n" * 5)
    (tmp_path / "b.csv").write_text("k,v\n7,b\n")
    with small_splits(spark, 20):
        rows = csvfiles.read_csv_mapped(spark, str(tmp_path), {"k": "k", "v": "v"}).orderBy("source_row").collect()
    assert [(r.source_row, r.k) for r in rows] == [(0, "1"), (1, "2"), (2, "7")]
    assert rows[1].v.startswith("open\n3,y\n4,zzz")


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_without_records(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("k,v\n")
    assert csvfiles.read_csv_mapped(spark, str(tmp_path), {"k": "k"}, multi_line=multi_line).count() == 0
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "b.csv").write_text("")
    assert csvfiles.read_csv_mapped(spark, str(tmp_path / "none"), {"k": "k"}, multi_line=multi_line).count() == 0


def test_header_and_title_may_cross_splits(spark, tmp_path):
    lines = ["Student report, exported today", '#,Name,Email,Address,State,"Teaching Experience, if any",Age '] + [
        f'{n},N{n},m{n}@x,"House ""{n}"",\nStreet",S,,4' for n in range(50)]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    with small_splits(spark, 24):
        rows = csvfiles.read_students(spark, str(tmp_path / "s.csv")).orderBy("source_row").collect()
    assert [(r.source_row, r.name, r.address, r.age_v2) for r in rows] == [
        (n, f"N{n}", f'House "{n}",\nStreet', "4") for n in range(50)]


def test_every_split_is_parsed_by_a_task_of_its_own(spark, tmp_path):
    (tmp_path / "s.csv").write_text("k,v\n" + "".join(f'{n},"two\nlines"\n' for n in range(3000)))
    with small_splits(spark, 4096):
        pieces = csvfiles._texts(spark, str(tmp_path / "s.csv"))
        assert pieces.select("block").distinct().count() > 5
        assert pieces.select(F.input_file_name().alias("part")).distinct().count() > 5
