"""Event messages as raw JSON bodies, written from their plain columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.fixtures import fixture
from tutorlake.functions.jsonfields import staged


def _data() -> Column:
    """JSON text of the data part; NULL fields are left out."""
    col = F.col
    user = F.when(~col("no_user"), col("u"))
    created = F.to_json(F.struct(
        user.alias("user_id"), "email", col("person").alias("name"), F.when(col("shape") != 2, col("ep")).alias("created_at")))
    whole = F.to_json(F.struct(
        F.struct(user.alias("id"), "email", col("person").alias("full_name"), F.lit("0123").alias("phone"), "city").alias("user")))
    entries = F.array(
        F.struct(F.lit(" CITY ").alias("field_display_name"), F.lit("x1").alias("field_name"), col("city").alias("field_value")),
        F.struct(F.lit("Post").alias("field_display_name"), F.lit("Pin Code").alias("field_name"), col("pin").alias("field_value")))
    flat = F.struct(user.alias("user_id"), "email", col("person").alias("name"), col("ep").alias("updated_at"))
    with_object = F.to_json(F.struct(flat["user_id"].alias("user_id"), "email", col("person").alias("name"), F.struct(
        col("city").alias("City"), col("parent").alias("Parent Name")).alias("system_fields")))
    with_list = F.to_json(F.struct(user.alias("user_id"), "email", col("person").alias("name"), col("ep").alias("updated_at"),
                                   entries.alias("system_fields")))
    plain = F.to_json(F.struct(user.alias("user_id"), "email", col("person").alias("name")))
    updated = (F.when(col("shape") == 0, whole).when(col("shape") == 1, with_object)
               .when(col("shape") == 2, with_list).otherwise(plain))
    purchase = F.to_json(F.struct(
        user.alias("user_id"), "email", col("person").alias("full_name"), col("b").alias("bundle_id"),
        F.when(~col("etype").endswith("failed"), col("m")).alias("master_batch_id"),
        col("v").alias("final_price"), F.lit("INR").alias("currency")))
    session = F.to_json(F.struct(
        user.alias("attendance_id"), col("m").alias("class_id"), F.concat(F.lit("Class "), col("st").cast("string")).alias("class_name"),
        col("ep").alias("gmt_start_time"), F.when(col("shape") == 1, col("ep") + 60).alias("taken_at"),
        F.when(~col("etype").endswith("cancel"), col("st")).alias("status")))
    assessment = F.to_json(F.struct(
        col("u").alias("user_id"), col("m").alias("attempt_id"),
        F.when(col("bad_mark"), F.lit("absent")).otherwise(col("v").cast("string")).alias("mark"),
        (col("st") % 2).alias("is_evaluated"),
        F.when(col("shape") == 0, col("ep")).alias("submitted_at"), F.when(col("shape") != 0, col("ep") + 5).alias("test_date")))
    completion = F.to_json(F.struct(
        col("u").alias("user_id"), col("b").alias("bundle_id"), F.when(col("shape") != 3, col("ep") + 7).alias("completed_at")))
    announcement = F.when(col("shape") == 3, F.lit("null")).otherwise(F.to_json(F.struct(col("e").alias("announcement_id"))))
    certificate = F.to_json(F.struct(
        F.concat(F.lit("CERT-"), col("e").cast("string")).alias("certificate_id"), col("u").alias("user_id"),
        (col("ep") + 9).alias("issued_at")))
    kind = col("etype")
    return (
        F.when(kind == "user.user_created", created).when(kind == "user.user_updated", updated)
        .when(kind.startswith("transaction."), purchase).when(kind.startswith("session."), session)
        .when(kind.startswith("assessments."), assessment).when(kind.startswith("course."), completion)
        .when(kind.startswith("announcement."), announcement).when(kind.startswith("certificate."), certificate)
        .otherwise(F.lit('{"message":"hello"}')))


def messages(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Landed messages: ``seq``, ``received_epoch``, ``received_at``, ``content_type``, ``body``.

    A file of events is read by as many tasks as it has row groups; ``dealt``, its rows are written as messages by more.
    """
    rows = fixture(spark, sf_dir, "messages", dealt=("events", "event_id") if dealt else None).withColumn("data", _data())
    event = F.to_json(F.struct(F.col("etype").alias("event"), F.col("iso").alias("event_ts"),
                               F.when(~F.col("live"), F.lit(False)).alias("livemode")))
    nested = F.concat(F.lit('{"event":'), event, F.lit(',"payload":'), F.col("data"), F.lit("}"))
    head = F.to_json(F.struct(
        F.when(~F.col("no_id"), F.concat(F.lit("ev-"), F.col("e").cast("string"))).alias("id"), F.col("etype").alias("event_name"),
        F.col("ep").alias("event_timestamp"), F.when(~F.col("live"), F.lit(False)).alias("is_live_mode")))
    flat = F.concat(F.expr("left(head, length(head) - 1)"), F.lit(',"data":'), F.col("data"), F.lit("}"))
    body = F.when(F.col("nested"), nested).otherwise(flat)
    written = rows.withColumn("head", head).withColumn("text", body).select(
        "seq", "received_epoch", F.timestamp_seconds("received_epoch").alias("received_at"),
        F.lit("application/json").alias("content_type"), "broken", "text")
    return staged(written, body=F.expr("CASE WHEN broken THEN left(text, length(text) - 4) ELSE text END")).drop("broken", "text")
