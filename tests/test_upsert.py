"""The fold against a row-by-row simulation."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tutorlake import session
from tutorlake.operators import upsert
from tutorlake.operators.policies import CATALOGUE_FROM_CSV, coalescing
from tutorlake.operators.upsert import FIRST, FIRST_VALUE, LAST, LAST_VALUE, last, last_value

SCHEMA = "seq int, k1 int, k2 int, w string, a string, b string, c string, d string, e string, f string"
WRITES = "w = 'x'"
POLICIES = {"a": LAST, "b": LAST_VALUE, "c": FIRST, "d": FIRST_VALUE, "e": last(WRITES), "f": last_value(WRITES)}
KEYS = ["k1", "k2"]


def one_by_one(table, changes):
    """Apply changes in order, as an insert-or-update statement would."""
    rows = [dict(r) for r in table]
    for change in sorted(changes, key=lambda r: r["seq"]):
        key = [change[k] for k in KEYS]
        found = None if None in key else next((r for r in rows if [r[k] for k in KEYS] == key), None)
        if found is None:
            rows.append({c: change[c] for c in (*KEYS, *POLICIES)})
            continue
        writes = change["w"] == "x"
        found["a"] = change["a"]
        found["b"] = change["b"] if change["b"] is not None else found["b"]
        found["d"] = found["d"] if found["d"] is not None else change["d"]
        if writes:
            found["e"] = change["e"]
            found["f"] = change["f"] if change["f"] is not None else found["f"]
    return rows


def as_set(rows):
    return sorted(tuple(repr(r[c]) for c in (*KEYS, *POLICIES)) for r in rows)


value = st.sampled_from([None, "p", "q"])
change = st.fixed_dictionaries({
    "k1": st.sampled_from([1, 2]), "k2": st.sampled_from([None, 1]), "w": st.sampled_from(["x", "y"]),
    **{c: value for c in POLICIES}})


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in SCHEMA.replace(",", "").split()[::2]) for r in rows], SCHEMA)


def numbered(rows):
    return [{**r, "seq": i} for i, r in enumerate(rows)]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(change, min_size=1, max_size=12), st.integers(0, 12))
def test_fold_equals_sequential_application_under_any_split(spark, changes, cut):
    changes = numbered(changes)
    expected = as_set(one_by_one([], changes))
    whole = upsert.fold(frame(spark, changes), KEYS, ["seq"], POLICIES)
    assert as_set(r.asDict() for r in whole.collect()) == expected
    first, second = changes[:cut], changes[cut:]
    state = upsert.fold(frame(spark, first), KEYS, ["seq"], POLICIES)
    state = upsert.apply(state, frame(spark, second), KEYS, ["seq"], POLICIES)
    assert as_set(r.asDict() for r in state.collect()) == expected


def test_null_keys_can_match(spark):
    rows = numbered([{"k1": 1, "k2": None, "w": "x", **dict.fromkeys(POLICIES, v)} for v in ("p", "q")])
    folded = upsert.fold(frame(spark, rows), KEYS, ["seq"], POLICIES, null_keys="match")
    assert [r.a for r in folded.collect()] == ["q"]


def test_hot_key_reaches_the_reducer_combined(spark):
    """A partial aggregation stands below the only shuffle."""
    rows = spark.range(1000).selectExpr("id % 3 AS k1", "1 AS k2", "'x' AS w", "id AS seq", *[f"'v' AS {c}" for c in POLICIES])
    plan = upsert.fold(rows, KEYS, ["seq"], POLICIES)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1
    assert "partial_max_by" in plan.split("Exchange")[1]


def test_coalescing_rule_keeps_last_known_values(spark):
    rule = coalescing(CATALOGUE_FROM_CSV)
    rows = spark.createDataFrame(
        [(1, 7, "A", "new", "Ongoing", 3), (2, 7, None, None, "Completed", None)],
        "source_row int, bundle_id int, subject string, course_name string, status string, num_students int")
    assert [tuple(r) for r in upsert.fold(rows, rule.keys, ["source_row"], rule.policies).select(
        "subject", "course_name", "status", "num_students").collect()] == [("A", "new", "Completed", 3)]


@pytest.mark.parametrize("policy, expected", [(LAST, None), (LAST_VALUE, "q"), (FIRST, None), (FIRST_VALUE, "q")])
def test_policies_and_nulls(spark, policy, expected):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, "q"), (1, 3, None)], "k int, seq int, v string")
    assert upsert.fold(rows, ["k"], ["seq"], {"v": policy}).first().v == expected


def test_other_columns_of_the_target_stay(spark):
    target = spark.createDataFrame([(1, "a", "kept", 5), (2, "b", "also", 6), (None, "n", "null key", 7)], "k int, v string, extra string, n int")
    changes = spark.createDataFrame([(1, "x", 1.5, 1), (3, "y", 2.5, 2), (None, "z", 3.5, 3)], "k int, v string, cost double, seq int")
    state = upsert.apply(target, changes, ["k"], ["seq"], {"v": upsert.LAST, "cost": upsert.FIRST})
    assert sorted(map(tuple, state.select("k", "v", "cost", "extra", "n").collect()), key=repr) == sorted([
        (1, "x", None, "kept", 5), (2, "b", None, "also", 6), (3, "y", 2.5, None, None), (None, "n", None, "null key", 7),
        (None, "z", 3.5, None, None)], key=repr)


@pytest.mark.parametrize("null_keys", ["append", "match"])
def test_stored_rows_are_dealt_by_key_once(spark, null_keys):
    """Rows with and without changes come from one shuffle; repeated stored keys without a change stay, so do NULL keys."""
    target = spark.createDataFrame([(1, 1, "t"), (2, 2, "u"), (2, 2, "u"), (None, 3, "n"), (4, 4, "v")], "k1 int, k2 int, a string")
    changes = spark.createDataFrame([(5, 1, 1, "c"), (6, None, 3, "d"), (7, 9, 9, "e")], "seq int, k1 int, k2 int, a string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = upsert.apply(target, changes, KEYS, ["seq"], {"a": LAST}, null_keys)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert plan.count("ReusedExchange") == 2
    same = [(None, 3, "d")] if null_keys == "match" else [(None, 3, "d"), (None, 3, "n")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 1, "c"), (2, 2, "u"), (2, 2, "u"), (4, 4, "v"), (9, 9, "e"), *same], key=str)


def test_only_keys_that_meet_are_dealt_out(spark):
    rng, schema = random.Random(5), "k long, g long, seq long, a string, b string"
    policies = {"a": upsert.FIRST, "b": upsert.LAST}

    def rows(n, after, keys):
        return spark.createDataFrame([(rng.choice([None, *range(keys)]), rng.choice([None, 1, 2, 3]), after + i, rng.choice([None, "x", "y"]), str(i))
                                      for i in range(n)], schema)

    changes, stored = session.stored(rows(60, 1000, 30), "test-changes"), rows(40, 0, 40)
    target = session.stored(upsert.fold(stored, ["k", "g"], ["seq"], policies).withColumn("kept", F.lit("old")), "test-target")
    keys = ["k", "g"]
    several = changes.groupBy(*keys).count().filter("count > 1").select(*keys)
    for there in (None, target):
        met = several if there is None else several.union(changes.join(there, keys).select(*keys))
        met = session.stored(met, "test-met")
        now = upsert.apply_where_met(there, changes, keys, ["seq"], policies, met)
        whole = upsert.fold(changes, keys, ["seq"], policies) if there is None else upsert.apply(there, changes, keys, ["seq"], policies)
        assert now.columns == whole.columns
        assert sorted(map(repr, now.collect())) == sorted(map(repr, whole.collect()))
    # Rows that meet nothing are read and passed on: only the groups of the others are shuffled.
    plan = now._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
