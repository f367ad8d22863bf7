"""Columns and types of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The silver tables.
SILVER = {
    "users": """
        event_id string, event_type string, user_id bigint, email string, full_name string, user_name string, user_role string,
        contact_number string, institution_id int, city string, state string, address string, pincode string, parent_name string,
        parent_email string, parent_contact string, custom_fields string, created_at timestamp, updated_at timestamp,
        received_at timestamp""",
    "transactions": """
        event_id string, event_type string, event_timestamp timestamp, user_id bigint, email string, full_name string,
        contact_number string, bundle_id bigint, course_name string, master_batch_id bigint, master_batch_name string,
        institution_bundle_id bigint, original_price decimal(12,2), discount decimal(12,2), final_price decimal(12,2),
        currency string, credits_applied decimal(12,2), payment_method string, transaction_id string, start_date timestamp,
        end_date timestamp, created_at timestamp, source string""",
    "sessions": """
        event_id string, event_type string, attendance_id bigint, class_id bigint, class_name string, class_type_formatted string,
        scheduled_start timestamp, scheduled_end timestamp, actual_start timestamp, duration_minutes int, teacher_id bigint,
        teacher_name string, teacher_email string, master_batches string, schedule_id bigint, is_recurring boolean,
        virtual_platform string, zoom_meeting_id string, cancellation_reason string, cancelled_by bigint, status int,
        is_late_signin boolean, delay_minutes int, reminder_type string, received_at timestamp""",
    "assessments": """
        event_id string, event_type string, user_id bigint, attempt_id bigint, exercise_id bigint, mark decimal(8,2),
        is_evaluated int, faculty_comments string, submitted_at timestamp, received_at timestamp""",
    "course_completion": """
        event_id string, event_type string, user_id bigint, bundle_id bigint, completed_at timestamp, received_at timestamp""",
    "announcements": "event_id string, event_type string, raw_data string, received_at timestamp",
    "certificates": """
        event_id string, event_type string, certificate_id string, user_id bigint, issued_at timestamp, received_at timestamp""",
    "class_attendance": """
        batch_id bigint, batch_name string, class_id bigint, bundle_id bigint, bundle_name string, class_date date, class_number int,
        present_count int, late_count int, absent_count int, total_records int, total_enrolled int, attendance_pct decimal(5,2),
        attendance_id bigint, teacher_id bigint, teacher_name string, class_duration string, pull_date date""",
    "course_batches": """
        bundle_id bigint, bundle_name string, batch_id bigint, batch_name string, batch_status string, start_date timestamp,
        end_date timestamp, tutor_id bigint, tutor_name string, admitted_students int""",
    "course_catalogue": """
        bundle_id bigint, course_name string, subject string, level string, language string, texts string, type string,
        course_type string, course_division string, division string, viniyoga string, certificate string, course_sponsor string,
        status string, number_of_lectures string, duration string, personas string, sss_category string,
        adhyayanam_category string, term_of_course string, position_in_funnel string, num_students int, course_ids string""",
    "course_lifecycle": """
        course_id bigint, course_name string, batch_name string, type_of_launch string, status string, subject string,
        position_in_funnel string, learning_model string, term_of_course string, sss_category string, persona string,
        first_class_date date, last_class_date date, enrollments_on_fc int, enrollments_on_lc int, avg_attendance decimal(8,2),
        total_classes_held int, total_certified int, pass_percentage decimal(5,2), overall_rating decimal(3,2), batch_id bigint""",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(SILVER[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows: the target of a first load."""
    return spark.createDataFrame([], schema(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """All columns of a table in their order and type; those the rows lack are NULL."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema(table).fields])
