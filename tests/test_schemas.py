"""Tables keep their columns, whichever of them a load writes."""

from tutorlake import schemas
from tutorlake.operators.policies import ROUTED_TABLES, CATALOGUE, CLASS_ATTENDANCE, COURSE_BATCHES, LIFECYCLE, USERS_BACKFILL
from tutorlake.operators.policies import TRANSACTIONS_BACKFILL
from tutorlake.plans import courses


def test_every_written_column_belongs_to_its_table(spark):
    rules = {**ROUTED_TABLES, "course_catalogue": CATALOGUE, "class_attendance": CLASS_ATTENDANCE,
             "course_batches": COURSE_BATCHES, "course_lifecycle": LIFECYCLE}
    for table, rule in [*rules.items(), ("users", USERS_BACKFILL), ("transactions", TRANSACTIONS_BACKFILL)]:
        assert {*rule.keys, *rule.policies} <= set(schemas.schema(table).names), table


def test_load_into_an_empty_table(spark):
    raw = spark.createDataFrame(
        [(0, "7", "Course", "Logic", "Ongoing", "1,200"), (1, "7.0", "course", "Later", "Completed", "3"), (2, "0", "Course", "x", None, "1")],
        "source_row long, bundle_id string, course_division string, course_name string, status string, num_students string")
    target = schemas.empty(spark, "course_catalogue")
    loaded = schemas.conform(courses.catalogue_from_raw(raw, target), "course_catalogue")
    assert loaded.schema == schemas.schema("course_catalogue")
    row = loaded.first()
    assert (loaded.count(), row.bundle_id, row.course_name, row.status, row.num_students, row.subject) == (1, 7, "Logic", "Ongoing", 1200, None)
    again = courses.catalogue_from_raw(raw, loaded)
    assert again.count() == 1
