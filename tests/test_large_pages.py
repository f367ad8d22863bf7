"""Pages that are cut by their structure give what parsing them whole gives."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_csv_splits import small_splits

from tutorlake.sources import pages


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(['a},b', 'x"y', "back\\slash", "[{", "}]", "é,", "", "line\nbreak", '\\"},{'])
    if kind < 4:
        return rng.choice([None, True, 1, -2.5, "plain", "two, words"])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice("abc") + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}


def entry(rng, n):
    return {"n": n, "v": value(rng), "w": {"x": [{"y": value(rng)}, 1]}}


def written(rng, page):
    return json.dumps(page, indent=rng.choice([None, None, 1]), ensure_ascii=rng.random() < 0.5, separators=rng.choice([None, (",", ":")]))


def rows_of(df, name):
    return sorted((r.page.rsplit("/", 1)[1], r.pos, json.dumps(json.loads(r.item), sort_keys=True))
                  for r in df.select("page", "pos", F.to_json(name).alias("item")).collect())


def make(rng, folder):
    def some(least, most):
        return [entry(rng, n) for n in range(rng.randrange(least, most))]

    shapes = {
        "rows": {"status": "ok", "data": some(5, 30), "page_context": {"has_more_page": True, "list": [1, {"a": 2}]}},
        "second": {"data": None, "rows": some(5, 30), "report": some(1, 5), "tail": 1},
        "empty": {"data": [], "rows": some(5, 20), "note": "x" * 300},
        "list": some(5, 30), "courses": {"result": {"a": 1}, "courses": some(5, 20), "items": some(2, 4)},
        "scalars": {"data": [[1, 2], "a},", 3, None, {"b": []}], "pad": "y" * 300}, "blank": {"data": [], "pad": "z" * 300},
    }
    for name, page in shapes.items():
        (folder / f"{name}.json").write_text(written(rng, page) + rng.choice(["", "\n"]))


@pytest.mark.parametrize("seed, size", [(1, 100), (2, 333), (3, 1 << 20), (4, 64)])
def test_cut_pages_give_the_rows_of_whole_pages(spark, tmp_path, seed, size):
    make(random.Random(seed), tmp_path)
    whole = pages.read_pages(spark, str(tmp_path))
    with small_splits(spark, size):
        cut = pages.read_pages(spark, str(tmp_path), limit=200)
    assert "first" in cut.columns and pages.page_rejects(cut).count() == 0
    assert rows_of(pages.unwrap_rows(cut, "page"), "row") == rows_of(pages.unwrap_rows(whole, "page"), "row")
    named = F.col("page").rlike("list|courses")
    assert rows_of(pages.unwrap_catalogue(cut.filter(named), "page"), "item") == rows_of(pages.unwrap_catalogue(whole.filter(named), "page"), "item")
    more = [sorted(r.page for r in pages.has_more_page(p).filter("has_more").select("page").distinct().collect()) for p in (cut, whole)]
    assert more[0] == more[1] and len(more[0]) == 1


def test_members_of_a_cut_page_are_its_courses(spark, tmp_path):
    page = {str(n): entry(random.Random(n), n) for n in range(100, 130)}
    (tmp_path / "a.json").write_text(json.dumps(page))
    with small_splits(spark, 150):
        cut = pages.unwrap_catalogue(pages.read_pages(spark, str(tmp_path), limit=100), "page")
    assert rows_of(cut, "item") == rows_of(pages.unwrap_catalogue(pages.read_pages(spark, str(tmp_path)), "page"), "item")


def test_batches_of_cut_pages_keep_their_places(spark, tmp_path):
    rng = random.Random(9)

    def bundle(n):
        batches = [{"id": f"{n}.{i}"} for i in range(rng.randrange(4))]
        return {"bundle_id": n, "bundle_name": f"B{n}", "batch": rng.choice([batches, json.dumps(batches), "none"])}

    (tmp_path / "a.json").write_text(json.dumps({"courses": [bundle(n) for n in range(40)]}))
    (tmp_path / "b.json").write_text(json.dumps([bundle(n) for n in range(40, 60)]))
    with small_splits(spark, 200):
        cut = pages.flatten_batches(pages.read_pages(spark, str(tmp_path), limit=100), "page")
        numbered = pages.number_rows(cut).select("source_row", "bundle_id", "bundle_name", F.to_json("batch").alias("b"))
    whole = pages.number_rows(pages.flatten_batches(pages.read_pages(spark, str(tmp_path)), "page"))
    assert sorted(numbered.collect()) == sorted(whole.select("source_row", "bundle_id", "bundle_name", F.to_json("batch").alias("b")).collect())


def test_broken_large_pages_are_rejected_whole(spark, tmp_path):
    sound = [entry(random.Random(n), n) for n in range(20)]
    (tmp_path / "sound.json").write_text(json.dumps({"data": sound}))
    (tmp_path / "torn.json").write_text(json.dumps({"data": sound})[:-40])
    (tmp_path / "odd.json").write_text(json.dumps({"data": sound}).replace('"n": 7', '"n": seven'))
    (tmp_path / "small.json").write_text("{")
    with small_splits(spark, 300):
        read = pages.read_pages(spark, str(tmp_path), limit=100)
        rejects = sorted((r.page.rsplit("/", 1)[1], r.reason) for r in pages.page_rejects(read).collect())
        assert pages.unwrap_rows(read, "page").count() == 20
    assert rejects == [("odd.json", pages.NOT_JSON), ("small.json", pages.NOT_JSON), ("torn.json", pages.NOT_JSON)]
