"""Checks over whole tables: every pull takes part in the chain, every event has its preview."""

import pytest

from __spark_entry__ import oracle_sql, queries
from checks import faults
from checks.compare import connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_chain_takes_every_pull(duck):
    text = oracle_sql()["attendance_chain_all_pulls"]
    head = text[:text.index("seen AS (")].rstrip().rstrip(",")
    every = " UNION ALL ".join(f"({load})" for load in faults._RANGES)
    loaded, stored = duck.sql(f"{head} SELECT (SELECT count(*) FROM ({every}) e), (SELECT count(*) FROM fx_attendance)").fetchall()[0]
    assert loaded == stored


def test_preview_of_every_event(spark):
    assert queries()["events_body_preview_all"](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
