"""Cleaning, parsing and formatting of text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from checks.common import query
from checks.fixtures import fixture, oracle, table
from tutorlake.functions import clean, headers, labels
from tutorlake.operators import predicates

_MESSY = """
CASE l_linenumber WHEN 1 THEN '  T' || CAST(quantity AS STRING) || ' ' WHEN 2 THEN 'nan' WHEN 3 THEN ' ' WHEN 4 THEN 'None'
 WHEN 5 THEN ' NaN ' WHEN 6 THEN NULL ELSE chr(9) || 'two words' || chr(10) END"""


def texts(spark, sf_dir, **columns: str) -> DataFrame:
    return fixture(spark, sf_dir, "texts").select("*", *[F.expr(text).alias(name) for name, text in columns.items()])


def texts_oracle(body: str, **columns: str) -> str:
    added = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return oracle(body, "texts", raw=f"SELECT *, {added} FROM fx_texts")


_TRIM = "trim({c}, ' ' || chr(9) || chr(10))"
_M = _TRIM.format(c="messy")


@query("clean_text_tokens", texts_oracle(f"""
SELECT row_key, CASE WHEN {_M} NOT IN ('', 'nan', 'None', 'NaN') THEN {_M} END AS cleaned,
 CASE WHEN {_M} NOT IN ('', 'nan', 'None') THEN {_M} END AS cleaned_short, NULLIF(messy, '') AS cell,
 CASE WHEN {_M} IN ('two words') THEN {_M} END AS listed FROM raw""", messy=_MESSY))
def _(spark, sf_dir):
    messy = texts(spark, sf_dir, messy=_MESSY)
    return messy.select(
        "row_key", clean.clean_text("messy").alias("cleaned"),
        clean.clean_text("messy", clean.NULL_TOKENS_SHORT).alias("cleaned_short"), clean.blank_to_null("messy").alias("cell"),
        predicates.listed_or_null(clean.clean_text("messy"), ("two words",)).alias("listed"))


_NUMBER = """
CASE l_linenumber WHEN 1 THEN ' ' || CAST(quantity AS STRING) || ' ' WHEN 2 THEN '1,' || CAST(200 + quantity AS STRING)
 WHEN 3 THEN CAST(quantity AS STRING) || '.7' WHEN 4 THEN '-' || CAST(quantity AS STRING) WHEN 5 THEN 'abc'
 WHEN 6 THEN CASE WHEN quantity % 3 = 0 THEN '0' WHEN quantity % 3 = 1 THEN '#VALUE!' ELSE '0x1' END
 ELSE CASE WHEN quantity % 3 = 0 THEN NULL WHEN quantity % 3 = 1 THEN '' ELSE '1e2' END END"""
_N, _C = "trim(number)", "replace(trim(number), ',', '')"
_INT, _DEC = "'^[+-]?[0-9]+$'", "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


@query("clean_numbers", texts_oracle(f"""
SELECT row_key, CASE WHEN regexp_matches({_N}, {_INT}) THEN CAST({_N} AS BIGINT) END AS whole,
 CASE WHEN regexp_matches({_C}, {_INT}) THEN CAST({_C} AS BIGINT) END AS whole_commas,
 CASE WHEN regexp_matches({_N}, {_DEC}) THEN CAST(trunc(CAST({_N} AS DOUBLE)) AS BIGINT) END AS truncated,
 CASE WHEN regexp_matches({_C}, {_DEC}) THEN CAST({_C} AS DOUBLE) END AS decimal_number,
 CASE WHEN {_N} NOT IN ('', '0', 'None') AND regexp_matches({_N}, {_INT}) THEN CAST({_N} AS BIGINT) END AS epoch,
 COALESCE(NULLIF(number, ''), 'other') AS text_or_other, COALESCE(NULLIF(quantity % 5, 0), -1) AS number_or_other
FROM raw""", number=_NUMBER))
def _(spark, sf_dir):
    rows = texts(spark, sf_dir, number=_NUMBER)
    return rows.select(
        "row_key", clean.safe_int("number").alias("whole"), clean.safe_int("number", commas=True).alias("whole_commas"),
        clean.safe_bigint("number").alias("truncated"), clean.safe_float("number").alias("decimal_number"),
        clean.epoch_or_null("number").alias("epoch"), clean.falsy_coalesce("number", F.lit("other")).alias("text_or_other"),
        clean.falsy_coalesce(F.col("quantity") % 5, F.lit(-1).cast("bigint"), zero=True).alias("number_or_other"))


_D, _MON, _Y = ("CAST(day(day) AS STRING)", "CAST(month(day) AS STRING)", "CAST(year(day) AS STRING)")
_MONTH_NAME = ("CASE month(day) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'apr' WHEN 5 THEN 'May' "
               "WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'AUG' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' "
               "ELSE 'Dec' END")
_DATE = f"""
CASE l_linenumber WHEN 1 THEN {_D} || ' ' || {_MONTH_NAME} || ' ' || {_Y} WHEN 2 THEN ' ' || CAST(day AS STRING)
 WHEN 3 THEN {_D} || '-' || {_MON} || '-' || {_Y} WHEN 4 THEN {_D} || '/' || {_MON} || '/' || {_Y}
 WHEN 5 THEN {_MON} || '/' || {_D} || '/' || {_Y} WHEN 6 THEN '31/31/' || {_Y} ELSE '' END"""
_SWAPPED = "CASE WHEN day(day) <= 12 THEN make_date(year(day), day(day), month(day)) ELSE day END"


@query("parse_dates_multi", texts_oracle(f"""
SELECT row_key, CASE WHEN l_linenumber IN (1, 2, 3, 4) THEN day WHEN l_linenumber = 5 THEN {_SWAPPED} END AS day_first,
 CASE WHEN l_linenumber IN (2, 5) THEN day WHEN l_linenumber = 4 THEN {_SWAPPED} END AS month_first FROM raw""", written=_DATE))
def _(spark, sf_dir):
    rows = texts(spark, sf_dir, written=_DATE)
    return rows.select("row_key", clean.parse_date("written").alias("day_first"),
                       clean.parse_date("written", clean.LIFECYCLE_DATE_FORMATS).alias("month_first"))


_HOUR = "(quantity % 24)"
_HM = f"lpad(CAST({_HOUR} AS STRING), 2, '0') || ':' || lpad(CAST(quantity AS STRING), 2, '0')"
_H12 = (f"CAST(CASE WHEN {_HOUR} % 12 = 0 THEN 12 ELSE {_HOUR} % 12 END AS STRING) || ':' || lpad(CAST(quantity AS STRING), 2, '0')"
        f" || CASE WHEN {_HOUR} < 12 THEN ' AM' ELSE ' PM' END")
_STAMP = f"""
CASE l_linenumber WHEN 1 THEN CAST(ship_epoch AS STRING) WHEN 2 THEN CAST(day AS STRING) || 'T' || {_HM} || ':30+05:30'
 WHEN 3 THEN CAST(day AS STRING) || ' ' || {_HM} || ':30' WHEN 4 THEN CAST(day AS STRING)
 WHEN 5 THEN {_D} || '-' || {_MON} || '-' || {_Y} || ' ' || {_H12} || ' IST' WHEN 6 THEN {_D} || '/' || {_MON} || '/' || {_Y}
 ELSE CASE WHEN quantity % 2 = 0 THEN 'NaN' ELSE 'yesterday' END END"""
_LOCAL = f"{_MON} || '/' || {_D} || '/' || {_Y} || ' ' || {_HM}"
_SECONDS = f"(ship_epoch + {_HOUR} * 3600 + quantity * 60)"


@query("parse_timestamps_multi", texts_oracle(f"""
SELECT row_key, CASE WHEN l_linenumber IN (1, 4, 6) THEN ship_epoch WHEN l_linenumber IN (2, 3) THEN {_SECONDS} + 30
  WHEN l_linenumber = 5 THEN {_SECONDS} END AS utc_epoch,
 CASE WHEN l_linenumber = 1 THEN ship_epoch WHEN l_linenumber IN (4, 6) THEN ship_epoch - 19800
  WHEN l_linenumber IN (2, 3) THEN {_SECONDS} + 30 - 19800 WHEN l_linenumber = 5 THEN {_SECONDS} - 19800 END AS ist_epoch,
 {_SECONDS} - 19800 AS local_epoch, CASE WHEN l_linenumber = 2 THEN {_SECONDS} + 30 - 19800 WHEN l_linenumber = 3 THEN {_SECONDS} + 30
  WHEN l_linenumber = 4 THEN ship_epoch END AS iso_epoch
FROM raw""", written=_STAMP, wall=_LOCAL))
def _(spark, sf_dir):
    rows = texts(spark, sf_dir, written=_STAMP, wall=_LOCAL)
    iso = F.when(F.col("l_linenumber").isin(2, 3, 4), F.col("written"))
    return rows.select(
        "row_key", F.unix_seconds(clean.parse_timestamp("written")).alias("utc_epoch"),
        F.unix_seconds(clean.parse_timestamp("written", zone="Asia/Kolkata")).alias("ist_epoch"),
        F.unix_seconds(clean.parse_local_timestamp("wall")).alias("local_epoch"), clean.iso_epoch(iso).alias("iso_epoch"))


_NAME = "' ' || p_name || '(' || p_type || ')__' || CAST(p_size AS STRING) || ' %'"


@query("sanitize_names", f"""
SELECT p_partkey, trim(regexp_replace(lower({_NAME}), '[^a-z0-9]+', '_', 'g'), '_') AS safe_name FROM part""")
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", headers.safe_name_column(F.expr(_NAME)).alias("safe_name"))


@query("epoch_to_local", oracle("""
SELECT seq, CAST(TIMESTAMP '1970-01-01' + to_seconds(received_epoch + 19800) AS DATE) AS local_day,
 date_diff('second', TIMESTAMP '1970-01-01', date_trunc('day', TIMESTAMP '1970-01-01' + to_seconds(received_epoch + 19800))) - 19800
  AS day_start,
 date_diff('second', TIMESTAMP '1970-01-01', date_trunc('day', TIMESTAMP '1970-01-01' + to_seconds(received_epoch + 19800))) + 66599
  AS day_end,
 CAST(year(TIMESTAMP '1970-01-01' + to_seconds(received_epoch)) AS INT) AS utc_year
FROM messages""", "messages"))
def _(spark, sf_dir):
    rows = fixture(spark, sf_dir, "messages").select("seq", clean.epoch_ts("received_epoch").alias("at"))
    local = rows.select("seq", "at", clean.local_date("at", "Asia/Kolkata").alias("local_day"))
    start, end = clean.day_window("local_day")
    return local.select("seq", "local_day", start.alias("day_start"), end.alias("day_end"),
                        F.year(clean.local_date("at")).alias("utc_year"))


@query("format_metrics", texts_oracle("""
SELECT row_key, COALESCE(format('{:,}', CAST(trunc(price * 1000) AS BIGINT)), '-') AS whole,
 COALESCE(format('{:,.2f}', CAST(price AS DOUBLE)), '-') AS money, COALESCE(format('{:.1f}%', quantity / 10.0), '--') AS share,
 COALESCE(CAST(l_suppkey AS STRING), '(not set)') AS label
FROM raw""", price="CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END"))
def _(spark, sf_dir):
    rows = texts(spark, sf_dir, price="CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END")
    return rows.select(
        "row_key", labels.thousands(F.col("price") * 1000).alias("whole"), labels.two_decimals(F.col("price")).alias("money"),
        labels.percent(F.col("quantity") / 10).alias("share"), labels.or_not_set(F.col("l_suppkey")).alias("label"))


_AS_OF = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)
_DAYS = f"CAST(floor(({int(_AS_OF.timestamp())} - received_epoch) / 86400.0) AS BIGINT)"


@query("days_ago_label", oracle(f"""
SELECT seq, CASE WHEN no_user THEN '-' WHEN {_DAYS} = 0 THEN 'today' WHEN {_DAYS} = 1 THEN 'yesterday'
 ELSE CAST({_DAYS} AS STRING) || ' days ago' END AS label FROM messages""", "messages"))
def _(spark, sf_dir):
    rows = fixture(spark, sf_dir, "messages")
    return rows.select("seq", labels.days_ago(F.when(~F.col("no_user"), F.col("received_epoch")), _AS_OF).alias("label"))
