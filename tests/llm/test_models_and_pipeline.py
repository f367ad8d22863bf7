"""Classifier, search, decontamination and the pipeline, against plain versions."""

import math
import zlib

import numpy as np
import pytest
from fixtures import components, documents, ordered, texts, words
from pyspark.sql import functions as F

import corpus_pipeline
from tutorlake.llm import quality, queries, sharding, templates, topk

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# Quality ------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op4_quality_classifier"](spark, LARGER).collect()}
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert all(r.held_out == _held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in found.items())
    held = [r for r in labels if _held_out(r.doc_id)]
    right = [found[r.doc_id].predicted == r.quality for r in held]
    assert sum(right) / len(right) >= 0.95
    for value in (0, 1):
        own = [r for r in held if r.quality == value]
        assert sum(found[r.doc_id].predicted == value for r in own) / len(own) >= 0.9


def test_quality_learns_from_its_own_folds_only(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()
    plain = spark.createDataFrame([tuple(r) for r in labels], "doc_id long, quality int")
    turned = spark.createDataFrame([(r.doc_id, 1 - r.quality if _held_out(r.doc_id) else r.quality) for r in labels],
                                   "doc_id long, quality int")
    renamed = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source")
    assert ordered(quality.quality_scores(docs, plain).collect()) == ordered(quality.quality_scores(renamed, turned).collect())


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(70, 1, "x"), (71, 0, "x"), (60, 1, "x"), (None, 1, "x"), (9, None, "x"), (10, 7, "x"), (10, 0, "x")],
                                   "doc_id long, quality int, text string")
    found = quality.quality_scores(documents(spark), labels).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((i for i, _, _ in texts()), key=repr)
    assert all(0 <= r.score <= 1 for r in found)
    by_text: dict = {}
    for doc_id, text, _ in texts():
        by_text.setdefault(text or "", set()).update(r.score for r in found if r.doc_id == doc_id and doc_id is not None and doc_id != 11)
    assert all(len(scores) <= 1 for scores in by_text.values())
    nothing = quality.quality_scores(documents(spark), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(0.5, 1)}
    assert quality.quality_scores(documents(spark, []), labels).count() == 0


def test_votes_equal_a_plain_count():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.05, (60, quality.FEATURES)).astype(np.float32)
    labels = (np.arange(60) % 3 > 0).astype(float)
    model = quality.fit(counts, labels)
    cosine = model.project(counts) @ model.vectors.T
    assert np.allclose(np.diag(cosine), 1, atol=1e-4)
    for row, got in zip(cosine, model.score(counts)):
        near = sorted(range(60), key=lambda j: -row[j])[:quality.NEIGHBOURS]
        weight = [min(1, max(0, row[j])) ** quality.SHARPNESS for j in near]
        assert got == pytest.approx(sum(w * labels[j] for w, j in zip(weight, near)) / sum(weight), abs=1e-4)


# Search -------------------------------------------------------------------------------------------------------------


def _nearest(rows, k, asked):
    kept = {}
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(64 * x) for x in vector]
        kept[vec_id] = min(v, kept.get(vec_id, v))
    for q in kept:
        if not asked(q):
            continue
        scores = [(-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q and len(v) == len(kept[q])]
        for rank, (score, i) in enumerate(sorted(scores)[:k], 1):
            yield q, rank, i, -score


@pytest.mark.parametrize("block", [2048, 7])
def test_search_equals_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)], 0) for i in range(90)]
    rows += [(200 + i, [0.5] * 6, 0) for i in range(60)]  # one vector in many copies
    rows += [(300, None, 1), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1),
             (None, [1.0] * 6, 1), (304, [], 1), (320, [], 1), (305, [1.0, 2.0], 1), (360, [3.0, -2.0], 1), (40, rows[40][1], 0),
             (-20, [0.25] * 6, 0)]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<float>, label int, block string, score int")
    found = topk.nearest(table, F.col("vec_id") % 20 == 0, k=7).collect()
    assert ordered(found) == ordered(_nearest(rows, 7, lambda q: q % 20 == 0))


def test_search_sends_no_block_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "TILE_BYTES", 60)  # each block is a tile, each query block a group
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, size=4) / 64], 0) for i in range(120)]
    table = spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<float>")
    found = topk.nearest(table, F.col("vec_id") % 3 == 0, k=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    assert ordered(found.collect()) == ordered(_nearest(rows, 5, lambda q: q % 3 == 0))


def test_tasks_hold_bounded_bytes_and_send_few():
    assert topk._dealing(1, 1, 200, 1, 1) == (1, 1)
    assert topk._dealing(25, 2, 48, 1, 1) == (24, 2)
    assert topk._dealing(7324, 367, 690, 33, 3) == (115, 6)
    assert topk._dealing(1000, 100, 8, 300, 40) == (300, 40)


@pytest.mark.parametrize("largest", [5, 2 ** 20, 2 ** 31])
def test_the_best_of_a_tile_in_each_kind_of_number(largest):
    rng, k = np.random.default_rng(10), 3
    blocks = [(np.sort(rng.permutation(400)[:40]) + 400 * i, rng.integers(-largest, largest + 1, (40, 2))) for i in range(4)]
    blocks[3][1][:] = blocks[2][1]  # equal scores under other ids
    tile = [(ids, matrix, topk._largest(matrix)) for ids, matrix in blocks]
    queries = tile[1]
    scores = np.hstack([queries[1] @ m.T for _, m, _ in tile]).astype(object)
    ids = np.concatenate([i for i, _, _ in tile])
    for i, own in enumerate(queries[0]):
        scores[i, ids == own] = topk.OWN
    low = np.array([sorted(line)[-k - i % 3] - 1 if i % 2 else -(1 << 62) for i, line in enumerate(scores)], np.int64)
    best = topk._best(queries, tile, k, low)
    assert [sorted(map(int, line)) for line in best] == [sorted(line)[-k:] for line in scores]
    rows, found, values = topk._nearest(queries, tile, k, low)
    expected = [(i, v, j) for i, line in enumerate(scores) for v, j in sorted(zip(line, ids), key=lambda p: (-p[0], p[1]))[:k]]
    assert sorted(zip(rows.tolist(), values.tolist(), found.tolist())) == sorted((i, int(v), int(j)) for i, v, j in expected)


def test_search_over_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.nearest(table, F.col("vec_id") % 20 == 0).count() == 0


def test_large_products_stay_exact(spark):
    rows = [(0, [2.0 ** 20] * 9), (1, [2.0 ** 20 + 1] * 9), (2, [2.0 ** 20 - 1] * 9), (3, [-(2.0 ** 20)] * 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.nearest(table, F.col("vec_id") == 0, k=3).collect()
    assert ordered(found) == ordered(_nearest(rows, 3, lambda q: q == 0))


# Decontamination ----------------------------------------------------------------------------------------------------

ITEM = ("A train leaves the northern station with 48 passengers and after 3 hours it has carried Alice over 210 km "
        "through the valley to the old harbour, where 48 others wait for the next departure.")
ITEMS = [(1, ITEM), (2, ITEM.replace("train", "coach")), (3, "What is 7 times 8 really"), (4, None), (None, "x " * 20), (5, "")]
FOREIGN = "the wind over the hills was calm and nobody had seen a bird since early spring when the river rose again quickly"


def _benchmark(spark, rows=None):
    return spark.createDataFrame([(i, t, 1) for i, t in (ITEMS if rows is None else rows)], "item_id long, text string, at int")


def test_leaks_and_clean_texts(spark):
    changed = ITEM.replace("48", "52").replace(" 3 ", " 5 ").replace("Alice", "Bob").replace("210", "300")
    # One number of the item stands for two numbers here, so the slots do not fit.
    torn = changed.replace("52 others", "61 others")
    rows = [(1, f"{FOREIGN} {ITEM} {FOREIGN}", "s"), (2, f"{FOREIGN}. {changed} {FOREIGN}", "s"), (3, ITEM.upper(), "s"), (4, FOREIGN, "s"),
            (5, f"{FOREIGN} {torn}", "s"), (6, "Well, what is 9 times 4 really?", "s"), (7, "12 34 56 78 90 12 34 56 78 90 12 34 56 78", "s"),
            (None, ITEM, "s"), (8, None, "s"), (9, "", "s"), (1, f"{FOREIGN} {ITEM} {FOREIGN}", "s"), (10, f"{FOREIGN} " * 3000 + ITEM, "s")]
    found = templates.contaminated(documents(spark, rows), _benchmark(spark)).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 6, 10, None}
    assert {r.doc_id for r in found if r.verbatim} == {1, 3, 10, None}
    assert all(r.item_id in (1, 2, 3) for r in found)
    first = next(r for r in found if r.doc_id == 1 and r.item_id == 1 and r.verbatim)
    assert first.first_word == len(words(FOREIGN)) and first.last_word == first.first_word + len(words(ITEM)) - 1
    kept = templates.clean(documents(spark, rows), _benchmark(spark))
    assert kept.columns == documents(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {4, 5, 7, 8, 9, None}


def test_leaks_of_nothing(spark):
    assert templates.contaminated(documents(spark), _benchmark(spark, [])).count() == 0
    assert templates.contaminated(documents(spark, []), _benchmark(spark)).count() == 0


def test_verbatim_items_of_the_tables(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").collect()
    items = spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()
    expected = {d.doc_id for d in docs if any(i.text in (d.text or "") for i in items)}
    found = queries.QUERIES["op8_benchmark_decontamination"](spark, LARGER).collect()
    assert {r.doc_id for r in found} == expected


# Pipeline -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result over the last one's, collected."""
    folder, docs, results = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    results.append((docs.columns, docs.collect()))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        results.append((docs.columns, docs.collect()))
    return results


def test_stages_keep_the_columns(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:-1])
    assert all(rows for _, rows in stages)


def test_quality_stage_keeps_what_is_predicted(spark, stages):
    predicted = {r.doc_id for r in queries.QUERIES["op4_quality_classifier"](spark, SF_DIR).filter("predicted = 1").collect()}
    assert {r.doc_id for r in stages[1][1]} == predicted
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1").collect()}
    assert len(good & predicted) >= 0.95 * len(good)


def test_duplicate_stage_keeps_the_smallest_of_each_group(stages):
    groups = components([(r.doc_id, r.text, None) for r in stages[1][1]])
    assert {r.doc_id for r in stages[2][1]} == {i for i, _, least in groups if i == least}


def test_decontamination_stage_drops_leaks_only(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages[2][1] if not any(i in r.text for i in items)}
    assert {r.doc_id for r in stages[3][1]} == clean


def test_mixing_stage_takes_near_the_targets(stages):
    from test_text_operators import _targets
    sizes: dict = {}
    for r in stages[3][1]:
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    target = _targets(sizes)
    for source in sizes:
        taken = sum(len(words(r.text)) for r in stages[4][1] if r.source == source)
        longest = max(len(words(r.text)) for r in stages[3][1] if r.source == source)
        assert abs(taken - target[source]) <= longest / 2 + 1


def test_sharding_stage_places_every_row(stages):
    rows = stages[5][1]
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stages[4][1])
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    counts = np.bincount([r.shard for r in rows], minlength=sharding.SHARDS)
    assert counts.max() - counts.min() <= 1


def test_run_is_all_stages(spark, stages):
    assert ordered(corpus_pipeline.run(spark, SF_DIR).collect()) == ordered(stages[5][1])
