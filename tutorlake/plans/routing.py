"""From accepted events to rows of the entity tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import clean
from tutorlake.functions.jsonfields import (
    LOCATION_ALIASES, PARENT_ALIASES, field_lookup, first_present, is_object, node_at, staged,
)
from tutorlake.operators import envelope, upsert
from tutorlake.operators.policies import ROUTED_TABLES, TableRule

MISSING_KEY = "missing key"
BAD_VALUE = "bad value"
NO_DATA = "data is not an object"

_EPOCH = "epoch"

#: Columns read from an event's data: type, then the names to look under.
#: ``epoch`` columns hold epoch seconds and become instants.
FIELDS: dict[str, dict[str, tuple[str, tuple[str, ...]]]] = {
    "users": {
        "user_id": ("bigint", ("user_id",)),
        "email": ("string", ("email",)),
        "full_name": ("string", ("name", "full_name")),
        "contact_number": ("string", ("phone", "contact_number")),
        "created_at": (_EPOCH, ("created_at",)),
        "updated_at": (_EPOCH, ("updated_at",)),
    },
    "transactions": {
        "user_id": ("bigint", ("user_id",)),
        "bundle_id": ("bigint", ("bundle_id",)),
        "master_batch_id": ("bigint", ("master_batch_id",)),
        "email": ("string", ("email",)),
        "full_name": ("string", ("name", "full_name")),
        "course_name": ("string", ("course_name",)),
        "master_batch_name": ("string", ("master_batch_name",)),
        "original_price": ("decimal(12,2)", ("original_price",)),
        "discount": ("decimal(12,2)", ("discount",)),
        "final_price": ("decimal(12,2)", ("final_price",)),
        "currency": ("string", ("currency",)),
    },
    "sessions": {
        "attendance_id": ("bigint", ("attendance_id",)),
        "class_id": ("bigint", ("class_id",)),
        "class_name": ("string", ("class_name",)),
        "class_type_formatted": ("string", ("class_type_formatted",)),
        "scheduled_start": (_EPOCH, ("gmt_start_time",)),
        "actual_start": (_EPOCH, ("actual_start_time", "taken_at")),
        "status": ("int", ("status",)),
    },
    "assessments": {
        "user_id": ("bigint", ("user_id",)),
        "attempt_id": ("bigint", ("attempt_id",)),
        "exercise_id": ("bigint", ("exercise_id",)),
        "mark": ("decimal(8,2)", ("mark",)),
        "is_evaluated": ("int", ("is_evaluated",)),
        "submitted_at": (_EPOCH, ("submitted_at", "test_date")),
    },
    "course_completion": {
        "user_id": ("bigint", ("user_id",)),
        "bundle_id": ("bigint", ("bundle_id",)),
        "completed_at": (_EPOCH, ("completed_at",)),
    },
    "announcements": {},
    "certificates": {
        "certificate_id": ("string", ("certificate_id",)),
        "user_id": ("bigint", ("user_id",)),
        "issued_at": (_EPOCH, ("issued_at",)),
    },
}
#: Instants that fall back to the event's own time.
_EVENT_TIME = ("created_at", "updated_at", "completed_at")
#: User columns that only an update writes.
_UPDATE_ONLY = ("contact_number", "updated_at", *LOCATION_ALIASES, *PARENT_ALIASES)


def _raw(names: Sequence[str]) -> str:
    return "__" + "_or_".join(names)


def _with_raw_texts(events: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Add the texts behind the fields of some tables, each read once.

    User updates may wrap the user in an object of its own; ``__subject`` is the
    document that holds the fields in either case.
    """
    nested = node_at(F.col("data"), "user")
    wrapped = (F.col("event_type") == "user.user_updated") & nested.isNotNull() & ~F.is_variant_null(nested)
    subject = staged(events, __subject=F.when(wrapped, nested).otherwise(F.col("data")))
    wanted = {_raw(names): names for table in tables for _, names in FIELDS[table].values()}
    if "users" in tables:
        wanted[_raw(["id"])] = ("id",)
    texts = {raw: first_present(F.col("__subject"), *names) for raw, names in wanted.items()}
    return staged(subject, __usable=is_object(F.col("data")) & is_object(F.col("__subject")), **texts)


def _typed(table: str) -> dict[str, Column]:
    """Typed columns of one table, from the raw texts."""
    columns = {}
    for name, (kind, names) in FIELDS[table].items():
        text = F.col(_raw(names))
        if kind == _EPOCH:
            seconds = text.try_cast("bigint")
            columns[name] = clean.epoch_ts(
                F.coalesce(seconds, F.col("event_epoch")) if name in _EVENT_TIME else seconds)
        else:
            columns[name] = text if kind == "string" else text.try_cast(kind)
    if table == "users":
        other_id = F.col(_raw(["id"])).try_cast("bigint")
        columns["user_id"] = F.when(_is_created(), columns["user_id"]).otherwise(
            F.coalesce(columns["user_id"], other_id))
    return columns


def _is_created() -> Column:
    return F.col("event_type") == "user.user_created"


def _problem(table: str, typed: dict[str, Column]) -> Column:
    """Why an event cannot enter its table; NULL when it can."""
    bad = F.lit(False)
    for kind, names in FIELDS[table].values():
        if kind != "string":
            text = F.col(_raw(names))
            value = text.try_cast("bigint" if kind == _EPOCH else kind)
            fits = F.coalesce(clean.epoch_fits(value), F.lit(False)) if kind == _EPOCH else value.isNotNull()
            bad = bad | (text.isNotNull() & ~fits)
    bad = bad | ~F.coalesce(clean.epoch_fits("event_epoch"), F.lit(True))
    missing = F.lit(False)
    for key in ROUTED_TABLES[table].required:
        missing = missing | typed[key].isNull()
    unusable = F.lit(False) if table == "announcements" else ~F.col("__usable")
    return F.when(unusable, F.lit(NO_DATA)).when(bad, F.lit(BAD_VALUE)).when(missing, F.lit(MISSING_KEY))


def entity_rows(events: DataFrame, table: str) -> DataFrame:
    """Typed rows of one table from its events, with ``seq`` and ``problem``.

    ``problem`` is NULL for sound rows.  The others stay unrouted: the key is
    missing, a value does not fit its column, or the data is not an object
    (announcements take any data).
    """
    mine = _with_raw_texts(events.filter(envelope.route(F.col("event_type")) == table), [table])
    typed = _typed(table)
    problem = _problem(table, typed)
    if table == "users":
        custom = node_at(F.col("data"), "system_fields")
        looked_up = {name: F.coalesce(first_present(F.col("__subject"), name), field_lookup(custom, names))
                     for name, names in LOCATION_ALIASES.items()}
        looked_up |= {name: field_lookup(custom, names) for name, names in PARENT_ALIASES.items()}
        typed["writer"] = F.when(_is_created(), F.lit("created")).otherwise(F.lit("updated"))
        typed["created_at"] = F.when(_is_created(), typed["created_at"])
        typed |= {name: F.when(~_is_created(), {**typed, **looked_up}[name]) for name in _UPDATE_ONLY}
    elif table == "transactions":
        typed["event_timestamp"] = clean.epoch_ts("event_epoch")
        typed["source"] = F.lit("webhook")
    elif table == "announcements":
        typed["raw_data"] = F.when(~F.is_variant_null("data"), F.to_json("data"))
    kept = [c for c in ("event_id", "event_type", "received_at") if c in events.columns]
    return mine.select(
        "seq", *kept, *[column.alias(name) for name, column in typed.items()], problem.alias("problem"))


def sound(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("problem").isNull()).drop("problem")


def problems(rows: DataFrame, table: str) -> DataFrame:
    """The open events among the rows of one table."""
    return rows.filter(F.col("problem").isNotNull()).select(
        "seq", "event_id", "event_type", F.lit(table).alias("route"), "problem")


def with_problem(events: DataFrame) -> DataFrame:
    """Add ``route`` and ``problem`` in one pass over the events."""
    tables = list(FIELDS)
    routed = _with_raw_texts(events.withColumn("route", envelope.route(F.col("event_type"))), tables)
    problem = F.lit(None).cast("string")
    for table in tables:
        problem = F.when(F.col("route") == table, _problem(table, _typed(table))).otherwise(problem)
    return routed.select(*events.columns, "route", problem.alias("problem"))


def retry_queue(events: DataFrame) -> DataFrame:
    """Events that could not be routed and stay open, with the reason."""
    return with_problem(events).filter(F.col("problem").isNotNull()).select(
        "seq", "event_id", "event_type", "route", "problem")


def fold_table(events: DataFrame, table: str, rule: TableRule | None = None, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """State of one entity table after all ``events``, in arrival order unless told otherwise."""
    rule = rule or ROUTED_TABLES[table]
    return upsert.fold(sound(entity_rows(events, table)), rule.keys, order_by, rule.policies)


def apply_table(target: DataFrame, events: DataFrame, table: str, rule: TableRule | None = None) -> DataFrame:
    """State of one entity table after further ``events``."""
    rule = rule or ROUTED_TABLES[table]
    return upsert.apply(target, sound(entity_rows(events, table)), rule.keys, ["seq"], rule.policies)


def route_counts(events: DataFrame) -> DataFrame:
    """Events per route and how many of them were processed.

    Pings are never routed; unknown types are done without any output.
    """
    done = F.col("problem").isNull() & (F.col("route") != envelope.PING_ROUTE)
    return with_problem(events).groupBy("route").agg(
        F.count("*").alias("total"), F.count_if(done).alias("processed"))
