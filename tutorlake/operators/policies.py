"""Merge policies of the warehouse tables: which change decides which column."""

from __future__ import annotations

from dataclasses import dataclass

from tutorlake.operators.upsert import (
    FIRST, FIRST_VALUE, LAST, LAST_VALUE, Policy, keep_first, last, last_value, replace_all,
)


@dataclass(frozen=True)
class TableRule:
    keys: tuple[str, ...]
    policies: dict[str, Policy]
    required: tuple[str, ...] = ()


def _columns(text: str) -> list[str]:
    return text.split()


#: Users receive two kinds of change; ``writer`` tells them apart.
_CREATED, _UPDATED = "writer = 'created'", "writer = 'updated'"

USERS = TableRule(
    keys=("user_id",),
    required=("user_id",),
    policies={
        "event_id": LAST,
        "event_type": last(_CREATED),
        "email": last_value(_CREATED),
        "full_name": last_value(_CREATED),
        "contact_number": FIRST,
        "city": LAST_VALUE,
        "state": LAST_VALUE,
        "address": LAST_VALUE,
        "pincode": LAST_VALUE,
        "parent_name": LAST_VALUE,
        "parent_email": LAST_VALUE,
        "parent_contact": LAST_VALUE,
        "created_at": FIRST,
        "updated_at": last(_UPDATED),
        "received_at": LAST,
    },
)

_TRANSACTION_COLUMNS = _columns(
    "event_type event_timestamp email full_name course_name master_batch_name "
    "original_price discount currency"
)

TRANSACTIONS = TableRule(
    keys=("user_id", "bundle_id", "master_batch_id"),
    required=("user_id",),
    policies={"event_id": LAST, "final_price": LAST, "source": LAST, **keep_first(_TRANSACTION_COLUMNS)},
)

SESSIONS = TableRule(
    keys=("attendance_id",),
    required=("attendance_id",),
    policies={
        "event_id": LAST,
        "status": LAST,
        "received_at": LAST,
        **keep_first(_columns(
            "event_type class_id class_name class_type_formatted scheduled_start actual_start")),
    },
)

ASSESSMENTS = TableRule(
    keys=("event_id",),
    policies={
        "mark": LAST,
        "received_at": LAST,
        **keep_first(_columns("event_type user_id attempt_id exercise_id is_evaluated submitted_at")),
    },
)

COMPLETIONS = TableRule(
    keys=("event_id",),
    policies=keep_first(_columns("event_type user_id bundle_id completed_at received_at")),
)

ANNOUNCEMENTS = TableRule(
    keys=("event_id",),
    policies=keep_first(_columns("event_type raw_data received_at")),
)

CERTIFICATES = TableRule(
    keys=("event_id",),
    policies=keep_first(_columns("event_type certificate_id user_id issued_at received_at")),
)

#: Target table of each route of the event router.
ROUTED_TABLES = {
    "users": USERS,
    "transactions": TRANSACTIONS,
    "sessions": SESSIONS,
    "assessments": ASSESSMENTS,
    "course_completion": COMPLETIONS,
    "announcements": ANNOUNCEMENTS,
    "certificates": CERTIFICATES,
}

_BACKFILL_TRANSACTION_COLUMNS = _columns(
    "event_id event_type course_name master_batch_name institution_bundle_id start_date end_date source"
)

#: Historical enrolments fill gaps of existing rows ...
TRANSACTIONS_BACKFILL = TableRule(
    keys=TRANSACTIONS.keys,
    required=("user_id",),
    policies={"email": FIRST_VALUE, "full_name": FIRST_VALUE, **keep_first(_BACKFILL_TRANSACTION_COLUMNS)},
)

#: ... or are only inserted.
TRANSACTIONS_INSERT_ONLY = TableRule(
    keys=TRANSACTIONS.keys,
    required=("user_id",),
    policies=keep_first(["email", "full_name", *_BACKFILL_TRANSACTION_COLUMNS]),
)

USERS_BACKFILL = TableRule(
    keys=("user_id",),
    required=("user_id",),
    policies={
        "full_name": FIRST_VALUE,
        **keep_first(_columns("event_id event_type email user_name city state address created_at")),
    },
)

ATTENDANCE_RAW = TableRule(
    keys=("student_id", "class_id"),
    policies={
        **replace_all(_columns(
            "pull_date attendance_status teacher_class_signin_status student_rating "
            "student_comments loaded_at")),
        **keep_first(_columns(
            "student_name reg_no student_email student_contact student_batch_status batch_id batch_name "
            "class_name bundle_id bundle_name course_id course_name attendance_id session_name teacher_id "
            "teacher_name teacher_email class_date class_date_parsed start_time end_time class_duration "
            "raw_payload")),
    },
)

CLASS_ATTENDANCE = TableRule(
    keys=("batch_id", "class_id"),
    required=("batch_id", "class_id"),
    policies={
        "bundle_id": FIRST,
        **replace_all(_columns(
            "batch_name bundle_name class_date present_count late_count absent_count total_records "
            "attendance_pct attendance_id teacher_id teacher_name class_duration pull_date")),
    },
)

COURSE_BATCHES_RAW = TableRule(
    keys=("source_row",),
    policies=replace_all(_columns(
        "bundle_id bundle_name batch_id batch_name batch_status start_date end_date tutor_id tutor_name "
        "admitted_students")),
)

COURSE_BATCHES = TableRule(
    keys=("bundle_id", "batch_id"),
    required=("bundle_id", "batch_id"),
    policies=replace_all(_columns(
        "bundle_name batch_name batch_status start_date end_date tutor_id tutor_name admitted_students")),
)

CATALOGUE_RAW = TableRule(
    keys=("source_row",),
    policies=replace_all(_columns(
        "bundle_id course_name course_description cost num_students tutors course_url subject level language "
        "type course_division status sss_category viniyoga adhyayanam_category term_of_course "
        "position_in_funnel division raw_json")),
)

CATALOGUE = TableRule(
    keys=("bundle_id",),
    required=("bundle_id",),
    policies=replace_all(_columns(
        "course_name subject level language texts type course_type course_division division viniyoga "
        "certificate course_sponsor status number_of_lectures duration personas sss_category "
        "adhyayanam_category term_of_course position_in_funnel num_students")),
)

CATALOGUE_FROM_CSV = TableRule(
    keys=("bundle_id",),
    required=("bundle_id",),
    policies={"course_name": LAST, "status": LAST, "num_students": LAST, "subject": FIRST},
)

CATALOGUE_INSERT_ONLY = TableRule(
    keys=("bundle_id",),
    required=("bundle_id",),
    policies=keep_first(["course_name", "cost"]),
)

LIFECYCLE = TableRule(
    keys=("course_id", "batch_name"),
    required=("course_id", "batch_name"),
    policies={
        "status": LAST,
        **keep_first(_columns(
            "course_name type_of_launch subject position_in_funnel learning_model term_of_course sss_category "
            "persona first_class_date last_class_date enrollments_on_fc enrollments_on_lc avg_attendance "
            "total_classes_held total_certified pass_percentage overall_rating batch_id")),
    },
)


def coalescing(rule: TableRule) -> TableRule:
    """The documented alternative: every column keeps its last known value."""
    return TableRule(rule.keys, dict.fromkeys(rule.policies, LAST_VALUE), rule.required)
