"""Scalar functions on literal inputs."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tutorlake.functions import clean, headers, jsonfields, labels
from tutorlake.operators import predicates


def evaluate(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("raw, expected", [
    ("  a b ", "a b"), (" x ", "x"), ("", None), (" nan ", None), ("None", None), ("NaN", None), (None, None), ("none", "none")])
def test_clean_text(spark, raw, expected):
    assert evaluate(spark, clean.clean_text(text(raw))) == expected


@pytest.mark.parametrize("raw, plain, commas, truncated", [
    (" 12 ", 12, 12, 12), ("1,234", None, 1234, None), ("12.7", None, None, 12), ("-3.9", None, None, -3), ("+5", 5, 5, 5),
    ("0x1", None, None, None), ("12d", None, None, None), ("1e3", None, None, 1000), ("", None, None, None),
    ("99999999999999999999", None, None, None), (None, None, None, None)])
def test_numbers(spark, raw, plain, commas, truncated):
    row = spark.range(1).select(
        clean.safe_int(text(raw)).alias("p"), clean.safe_int(text(raw), commas=True).alias("c"), clean.safe_bigint(text(raw)).alias("t")).first()
    assert (row.p, row.c) == (plain, commas)
    assert row.t == truncated or raw == "99999999999999999999"


@pytest.mark.parametrize("raw, expected", [
    ("16 Mar 2026", date(2026, 3, 16)), ("5 mar 2026", date(2026, 3, 5)), ("2026-03-16", date(2026, 3, 16)),
    ("16-03-2026", date(2026, 3, 16)), ("3/4/2026", date(2026, 4, 3)), ("3/16/2026", date(2026, 3, 16)),
    ("31/2/2026", None), ("soon", None), ("", None), (None, None)])
def test_attendance_dates(spark, raw, expected):
    assert evaluate(spark, clean.parse_date(text(raw))) == expected


def test_month_first_dates(spark):
    assert evaluate(spark, clean.parse_date(text("3/4/2026"), clean.LIFECYCLE_DATE_FORMATS)) == date(2026, 3, 4)


def _epoch(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize("raw, expected", [
    ("1709853000", 1709853000), ("1709853000.9", 1709853000), ("2024-03-08T04:30:00+05:30", _epoch(2024, 3, 8, 4, 30)),
    ("08-03-2024 04:30 PM IST", _epoch(2024, 3, 8, 16, 30)), ("8/3/2024", _epoch(2024, 3, 8)), ("3/28/2024", _epoch(2024, 3, 28)),
    ("nan", None), ("later", None)])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, raw, expected, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert evaluate(spark, F.unix_seconds(clean.parse_timestamp(text(raw)))) == expected
        assert evaluate(spark, clean.local_date(F.timestamp_seconds(F.lit(1709836200)), "Asia/Kolkata")) == date(2024, 3, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_and_local_text(spark):
    assert evaluate(spark, clean.iso_epoch(text("2024-03-08T10:00:00+05:30"))) == _epoch(2024, 3, 8, 4, 30)
    assert evaluate(spark, clean.iso_epoch(text("2024-03-08 10:00:00"))) == _epoch(2024, 3, 8, 10)
    assert evaluate(spark, clean.iso_epoch(text("whenever"))) is None
    assert evaluate(spark, F.unix_seconds(clean.parse_local_timestamp(text("3/8/2024 10:00")))) == _epoch(2024, 3, 8, 4, 30)


def test_headers():
    assert headers.sanitize_header(["Name", " name ", "Cost (INR)", "NAME!", "__x__"]) == ["name", "name_1", "cost_inr", "name_2", "x"]


@pytest.mark.parametrize("doc, expected", [
    ('{"City": "A"}', "A"), ('{"city": null, "City": "B"}', "B"), ('{"CITY": "C"}', None),
    ('[{"field_display_name": " CITY ", "field_value": "D"}]', "D"),
    ('[{"field_name": "other", "field_value": "x"}, 7, {"field_name": "City", "field_value": "E"}]', "E"),
    ('"city"', None), ("null", None)])
def test_field_lookup(spark, doc, expected):
    assert evaluate(spark, jsonfields.field_lookup(F.parse_json(F.lit(doc)), ("city", "City"))) == expected


@pytest.mark.parametrize("doc, expected", [
    ('{"a": 0, "b": 5}', "5"), ('{"a": "0", "b": 5}', "0"), ('{"a": "", "b": 0}', "0"), ('{"a": null}', None), ('{"b": "z"}', "z"),
    ('{"a": false, "b": "z"}', "z"), ('{"a": 3}', "3")])
def test_first_truthy(spark, doc, expected):
    assert evaluate(spark, jsonfields.first_truthy(F.parse_json(F.lit(doc)), "a", "b")) == expected


def test_labels(spark):
    as_of = datetime(2024, 3, 8, 12, tzinfo=timezone.utc)
    row = spark.range(1).select(
        labels.thousands(F.lit(1234567.9)).alias("a"), labels.two_decimals(F.lit(1234.5)).alias("b"),
        labels.percent(F.lit(12.34)).alias("c"), labels.thousands(F.lit(None).cast("double")).alias("d"),
        labels.days_ago(F.lit(_epoch(2024, 3, 8)), as_of).alias("e"), labels.days_ago(F.lit(_epoch(2024, 3, 7)), as_of).alias("f"),
        labels.days_ago(F.lit(_epoch(2024, 3, 1)), as_of).alias("g"), labels.days_ago(F.lit(None).cast("bigint"), as_of).alias("h"),
        labels.or_not_set(text(None)).alias("i")).first()
    assert tuple(row) == ("1,234,567", "1,234.50", "12.3%", "-", "today", "yesterday", "7 days ago", "-", "(not set)")


def test_staff_and_batch_rules_treat_nulls_differently(spark):
    rows = spark.createDataFrame([("a@staff.x",), ("a@STAFF.x",), ("a@x",), (None,)], "email string")
    assert [r.email for r in rows.filter(predicates.not_staff()).collect()] == ["a@STAFF.x", "a@x"]
    assert [r.email for r in rows.filter(~predicates.staff_at_ingest(F.col("email"))).collect()] == ["a@x", None]
    names = spark.createDataFrame([("Test batch 1",), ("test my BATCH",), ("Real",), (None,)], "n string")
    assert [r.n for r in names.filter(predicates.not_test_batch(F.col("n"))).collect()] == ["test my BATCH", "Real"]
    assert [r.n for r in names.filter(predicates.not_test_batch_any_case(F.col("n"))).collect()] == ["Real", None]

# --- fast paths give what the whole way gives ---------------------------------


def test_plain_numbers_and_dates_are_not_cleaned_first(spark):
    texts = ["12", " 12 ", "\u200312\xa0", "+7", "-0", "0", " 0 ", "00", "", "None", "1.5", "12\n", "12\x85", "\x0012", "9" * 20, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        clean.safe_int("t").alias("i"), clean.epoch_or_null("t").alias("e"))
    whole = [12, 12, 12, 7, 0, 0, 0, 0, None, None, None, 12, 12, None, None, None]
    assert [r.i for r in got.collect()] == whole
    assert [r.e for r in got.collect()] == [*whole[:5], None, None, *whole[7:]]
    days = ["3 Mar 2024", " 3  Mar 2024 ", "2024-3-3", "31/2/2024", "3/13/2024", "soon", None]
    got = spark.createDataFrame([(t,) for t in days], "t string").select(clean.parse_date("t").cast("string").alias("d")).collect()
    assert [r.d for r in got] == ["2024-03-03", "2024-03-03", "2024-03-03", None, "2024-03-13", None, None]


def test_an_instant_asks_for_its_seconds_three_times_at_most(spark):
    assert str(clean.epoch_ts(F.col("seconds"))).count("seconds") - str(clean.epoch_ts(F.col("s"))).count("seconds") <= 3
