"""Event envelopes: parsing, rejection, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tutorlake.functions import clean
from tutorlake.functions.jsonfields import accept_repeated_keys, is_object, is_present, node_at, staged, text_at, typed_at

# Reject classes.
NOT_JSON = "Not JSON"
NO_ID = "No ID"
NO_TYPE = "Bronze fail"

# Event types and their routes, first match wins.
EXACT_ROUTES = (
    ("user.user_created", "users"),
    ("user.user_updated", "users"),
    ("course.user_course_completed", "course_completion"),
    ("announcement.announcement_created", "announcements"),
    ("certificate.certificate_issued", "certificates"),
)
PREFIX_ROUTES = (
    ("transaction.user_purchase_", "transactions"),
    ("session.session_", "sessions"),
    ("assessments.", "assessments"),
)
PING_TYPE = "url.validate"
PING_ROUTE = "ping"
NO_ROUTE = "none"


def _flag(present: str, value: str) -> Column:
    """Boolean that defaults to true when its key is missing."""
    return F.when(F.col(present), F.col(value)).otherwise(F.lit(True))


def parse(df: DataFrame, body: str = "body") -> DataFrame:
    """Add the envelope's columns to raw messages.

    Added: ``event_id``, ``event_type``, ``is_live``, ``data`` (VARIANT),
    ``event_epoch`` and ``reject_reason`` (NULL for accepted messages).  A body
    that is JSON but not an object counts as not JSON.

    A message is nested when it has an ``event`` and no ``id``; its id then is
    its type and time stamp, in which a missing or null part reads ``None``.
    """
    accept_repeated_keys(df.sparkSession)
    doc = F.col("__doc")
    parsed = staged(df, __doc=F.try_parse_json(F.col(body)))
    parts = staged(
        parsed,
        __readable=is_object(doc),
        __nested=is_present(doc, "event") & ~is_present(doc, "id"),
        __event_is_object=is_object(node_at(doc, "event")),
        __event_type=text_at(doc, "event", "event"),
        __has_stamp=is_present(doc, "event", "event_ts"),
        __stamp=text_at(doc, "event", "event_ts"),
        __has_event_live=is_present(doc, "event", "livemode"),
        __event_live=typed_at(doc, "boolean", "event", "livemode"),
        __payload=node_at(doc, "payload"),
        __id=text_at(doc, "id"),
        __name=text_at(doc, "event_name"),
        __has_live=is_present(doc, "is_live_mode"),
        __live=typed_at(doc, "boolean", "is_live_mode"),
        __data=node_at(doc, "data"),
        __epoch=typed_at(doc, "bigint", "event_timestamp"),
    )
    nested, none = F.col("__nested"), F.lit("None")
    stamp = F.when(F.col("__has_stamp"), F.coalesce("__stamp", none)).otherwise(F.lit(""))
    nested_id = F.concat(F.coalesce("__event_type", none), F.lit("-"), stamp)
    event_id = F.when(F.col("__readable"), F.when(nested, nested_id).otherwise(F.col("__id")))
    event_type = F.when(nested, F.col("__event_type")).otherwise(F.col("__name"))
    data = F.when(nested, F.col("__payload")).otherwise(F.col("__data"))
    reason = (
        F.when(~F.col("__readable"), F.lit(NOT_JSON))
        .when(event_id.isNull(), F.lit(NO_ID))
        .when(event_type.isNull(), F.lit(NO_TYPE))
    )
    return parts.select(
        *df.columns,
        event_id.alias("event_id"), event_type.alias("event_type"),
        F.when(nested, _flag("__has_event_live", "__event_live")).otherwise(_flag("__has_live", "__live")).alias("is_live"),
        F.coalesce(data, F.parse_json(F.lit("{}"))).alias("data"),
        F.when(F.col("__event_is_object"), clean.iso_epoch("__stamp")).otherwise(F.col("__epoch")).alias("event_epoch"),
        reason.alias("reject_reason"),
    )


def route(event_type: Column) -> Column:
    """Target table of an event type; unknown types go nowhere."""
    chain = F.when(event_type == PING_TYPE, F.lit(PING_ROUTE))
    for name, target in EXACT_ROUTES:
        chain = chain.when(event_type == name, F.lit(target))
    for prefix, target in PREFIX_ROUTES:
        chain = chain.when(event_type.startswith(prefix), F.lit(target))
    return chain.otherwise(F.lit(NO_ROUTE))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(parsed: DataFrame, body: str = "body") -> DataFrame:
    """Dead letters: reason, raw body and whatever else came with the message."""
    bad = parsed.filter(F.col("reject_reason").isNotNull())
    keep = [c for c in bad.columns if c not in ("event_id", "event_type", "is_live", "data", "event_epoch", "reject_reason", body)]
    return bad.select(*keep, F.col("reject_reason").alias("failure_reason"), F.col(body).alias("raw_body"))
