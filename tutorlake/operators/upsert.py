"""Keyed upsert as an order-aware fold.

A table keeps one row per key; changes arrive in an order.  Instead of applying
them one by one, each column states which change decides it, and one grouped
aggregation finds that change.  ``min_by``/``max_by`` combine on the map side,
so a key that owns a third of all changes reaches the reducer as one row per
map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Policy:
    """Which change decides a column.

    ``last``/``first`` keep a NULL of the deciding change, the ``_value`` forms
    skip NULLs.  ``when`` (SQL text) limits the changes that may overwrite; the
    others only count where they create the row.
    """

    kind: str
    when: str | None = None


LAST = Policy("last")
LAST_VALUE = Policy("last_value")
FIRST = Policy("first")
FIRST_VALUE = Policy("first_value")


def last(when: str | None = None) -> Policy:
    return Policy("last", when)


def last_value(when: str | None = None) -> Policy:
    return Policy("last_value", when)


def keep_first(columns: Sequence[str]) -> dict[str, Policy]:
    """Insert-only table: the first row of a key stays as it is."""
    return dict.fromkeys(columns, FIRST)


def replace_all(columns: Sequence[str]) -> dict[str, Policy]:
    """Every column follows the last change, NULL included."""
    return dict.fromkeys(columns, LAST)


def _key_has_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def _matching(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The keys of some rows under other names, and the condition that they equal a row's own."""
    same = F.lit(True)
    for key in keys:
        # Null-safe in either case: an equality would filter one of two joins' input, and they could not share its shuffle.
        same = same & F.col(key).eqNullSafe(F.col(f"__key_{key}"))
    return rows.select(*[F.col(k).alias(f"__key_{k}") for k in keys]), same


def _fold(rows: DataFrame, keys: Sequence[str], order: Column, policies: Mapping[str, Policy],
          is_change: Column, null_keys: str) -> DataFrame:
    """One grouped aggregation; ``order`` is unique within a key."""
    group = [F.col(key) for key in keys]
    if null_keys == "append":
        # A key with a NULL part never meets another row: give it a group of its own.
        group.append(F.when(_key_has_null(keys), order).alias("__alone"))

    first_cols = [c for c, p in policies.items() if p.kind == "first" or p.when]
    aggregates = {}
    if first_cols:
        aggregates["__first"] = F.min_by(F.struct(*first_cols), order)
    by_condition: dict[str | None, list[str]] = {}
    for name, policy in policies.items():
        if policy.kind == "last":
            by_condition.setdefault(policy.when, []).append(name)
    slots = {}
    for number, (condition, names) in enumerate(by_condition.items()):
        slots[condition] = f"__last{number}"
        rank = order if condition is None else F.when(F.expr(condition) & is_change, order)
        aggregates[slots[condition]] = F.max_by(F.struct(*names), rank)
    for name, policy in policies.items():
        has_value = F.col(name).isNotNull()
        if policy.kind == "last_value":
            writes = has_value if policy.when is None else has_value & F.expr(policy.when) & is_change
            aggregates[f"__{name}"] = F.max_by(F.col(name), F.when(writes, order))
        elif policy.kind == "first_value":
            aggregates[f"__{name}"] = F.min_by(F.col(name), F.when(has_value, order))

    def result(name: str, policy: Policy) -> Column:
        created = F.col("__first").getField(name) if "__first" in aggregates and name in first_cols else None
        if policy.kind == "first":
            return created
        if policy.kind == "last":
            slot = F.col(slots[policy.when])
            if policy.when is None:
                return slot.getField(name)
            return F.when(slot.isNotNull(), slot.getField(name)).otherwise(created)
        found = F.col(f"__{name}")
        return found if created is None else F.coalesce(found, created)

    folded = rows.groupBy(*group).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return folded.select(*keys, *[result(name, policy).alias(name) for name, policy in policies.items()])


def fold(changes: DataFrame, keys: Sequence[str], seq: Sequence[str], policies: Mapping[str, Policy],
         null_keys: str = "append") -> DataFrame:
    """Table that results from applying all ``changes`` in ``seq`` order to nothing.

    ``null_keys="append"``: NULL key parts differ from everything, so such rows
    are all kept.  ``null_keys="match"``: NULL equals NULL.
    """
    return _fold(changes, keys, F.struct(*seq), policies, F.lit(True), null_keys)


def apply(target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: Sequence[str],
          policies: Mapping[str, Policy], null_keys: str = "append", changed: DataFrame | None = None) -> DataFrame:
    """``target`` after ``changes``: its rows come before every change.

    Columns of the target that the rule does not name stay as they are, and are NULL in new rows; columns that the
    target lacks are added.  Only stored rows whose key is among the changes enter the aggregation.  ``changed`` names
    these keys where they are at hand; keys without a change do no harm.
    """
    kept = [c for c in target.columns if c not in keys and c not in policies]
    columns = [*keys, *policies]
    conditions = {p.when for p in policies.values() if p.when}
    kinds = {f.name: f.dataType for f in changes.schema.fields}
    stored = target.select(*target.columns, *[
        F.lit(None).cast(kinds[c]).alias(c) for c in columns if c not in target.columns]).select(*columns, *kept)
    named = changes.select(*keys).distinct() if changed is None else changed
    changed, same = _matching(named if null_keys == "match" else named.filter(~_key_has_null(keys)), keys)
    untouched = stored.join(changed, same, "left_anti")
    stored = stored.join(changed, same, "left_semi")
    policies = {**policies, **keep_first(kept)}
    incoming = changes.select(
        *columns, F.struct(*seq).alias("__seq"), F.lit(True).alias("__change"),
        *[F.expr(c).alias(f"__when{i}") for i, c in enumerate(sorted(conditions))],
        *[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in kept],
    )
    rows = incoming.unionByName(stored.withColumn("__change", F.lit(False)), allowMissingColumns=True)
    renamed = {c: f"__when{i}" for i, c in enumerate(sorted(conditions))}
    policies = {n: Policy(p.kind, renamed.get(p.when)) for n, p in policies.items()}
    result = _fold(rows, keys, F.struct("__change", "__seq"), policies, F.col("__change"), null_keys)
    return result.unionByName(untouched)


def apply_where_met(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], seq: Sequence[str],
                    policies: Mapping[str, Policy], met: DataFrame) -> DataFrame:
    """``apply``, or ``fold`` without a target, where ``met`` holds the keys of several changes or of a change and a stored row.

    Every other change, one with a NULL in its key too, is a row of the result as it is, so that only rows of the keys that
    meet are dealt out by key.  With a small stored ``met`` the rest moves nowhere.
    """
    named, same = _matching(met.filter(~_key_has_null(keys)), keys)
    alone = changes.join(named, same, "left_anti").select(*keys, *policies)
    meeting = changes.join(named, same, "left_semi")
    if target is None:
        return fold(meeting, keys, seq, policies).unionByName(alone)
    return apply(target, meeting, keys, seq, policies, changed=met).unionByName(alone, allowMissingColumns=True)
