"""The pipeline's stages over rows that share an id or have none."""

from fixtures import documents, words

import corpus_pipeline
from tutorlake.llm import mixing

SF_DIR = "/root/testdata/sf0.001"
FIRST = " ".join(f"alpha{i}" for i in range(40))
SECOND = " ".join(f"beta{i}" for i in range(40))


def test_one_row_of_each_group_of_near_duplicates_stays(spark):
    third, fourth = FIRST.replace("alpha", "gamma"), FIRST.replace("alpha", "delta")
    rows = [(1, FIRST, "s"), (1, FIRST, "s"), (None, FIRST, "s"), (2, FIRST, "s"), (2, SECOND, "s"), (None, third, "s"), (None, third, "s"),
            (3, fourth, "s"), (None, None, "s"), (None, None, "s"), (3, "", "s")]
    kept = corpus_pipeline.near_duplicate_stage(spark, documents(spark, rows), SF_DIR)
    assert kept.columns == documents(spark, []).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, FIRST), (2, SECOND), (None, third), (3, fourth), (None, None), (None, None), (3, "")], key=repr)


def test_leaks_go_by_row(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rows = [(1, f"{FIRST} {item}", "s"), (1, SECOND, "s"), (None, f"{SECOND} {item}", "s"), (None, FIRST, "s"), (None, None, "s")]
    kept = corpus_pipeline.decontamination_stage(spark, documents(spark, rows), SF_DIR)
    assert kept.columns == documents(spark, []).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, SECOND), (None, FIRST), (None, None)], key=repr)


def test_mix_meets_its_targets_where_rows_share_ids(spark):
    rows = [(None if i % 2 else 7, f"{FIRST} own{i}", "abc"[i % 3]) for i in range(300)]
    docs = documents(spark, rows)
    target = {r.source: r.target for r in mixing.mixed(docs).collect()}
    taken = dict.fromkeys(target, 0)
    for r in corpus_pipeline.mixing_stage(spark, docs, SF_DIR).collect():
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - target[s]) <= 41 / 2 + 1 for s in target)
