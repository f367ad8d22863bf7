"""Row predicates whose treatment of NULL and case differs on purpose."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values.
VALID_STATUSES = ("Completed", "Ongoing", "Upcoming")
COUNTED_ATTENDANCE = ("P", "L", "A")
TEST_EVENT_PATTERN = "^(e2e|dupe|resilience|conc|dbtest|constraint|manual|load)-"
FIRST_TEST_USER_ID = 99990000

#: Markers of staff accounts; every deployment passes its own.
STAFF_PATTERN = "%@staff%"
STAFF_TOKEN = "@staff"


def not_staff(email: Column | str = "email", pattern: str = STAFF_PATTERN) -> Column:
    """Report rule: case-sensitive, an unknown e-mail is excluded too."""
    return ~F.col(email).like(pattern) if isinstance(email, str) else ~email.like(pattern)


def staff_at_ingest(email: Column, token: str = STAFF_TOKEN) -> Column:
    """Ingestion rule: any case, an unknown e-mail is not staff."""
    return F.coalesce(F.contains(F.lower(email), F.lit(token.lower())), F.lit(False))


def not_test_batch(name: Column) -> Column:
    """Master-table rule: case-sensitive, unnamed batches are dropped."""
    return ~name.like("%Test batch%")


def not_test_batch_any_case(name: Column) -> Column:
    """Batch-import rule: any case, unnamed batches stay."""
    return name.isNull() | (~name.ilike("%test batch%") & ~name.ilike("%test%batch%"))


def listed_or_null(c: Column, allowed: Sequence[str] = VALID_STATUSES) -> Column:
    return F.when(c.isin(*allowed), c)


def test_user(email: Column | None, user_id: Column) -> Column:
    """Rows left behind by test runs; never NULL, so its negation keeps the rest."""
    found = user_id >= FIRST_TEST_USER_ID
    if email is not None:
        found = email.like("%test%") | email.like("%load%") | found
    return F.coalesce(found, F.lit(False))


def test_event(event_id: Column) -> Column:
    return F.coalesce(event_id.rlike(TEST_EVENT_PATTERN), F.lit(False))
