"""Rule sets of the benefits tables (table CHECKs, NOT NULLs, gold suite)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    ACTIVITY_SOURCES,
    BUSINESS_UNITS,
    CONTRACT_TYPES,
    QUALITY_SALARY_RANGE,
    QUALITY_TOTAL_COST_RANGE,
    TRANSPORT_MODES,
)
from ..operators import quality

def employee_checks() -> dict[str, Column]:
    return {
        "chk_contract_type": F.col("contract_type").isin(CONTRACT_TYPES),
        "chk_transport_mode": F.col("transport_mode").isin(TRANSPORT_MODES),
    }

def activity_checks() -> dict[str, Column]:
    return {
        "chk_distance_positive": F.col("distance_m").isNull() | (F.col("distance_m") >= 0),
        "chk_duration_positive": F.col("duration_s") > 0,
        "chk_dates_coherent": F.col("end_at") > F.col("start_at"),
        "chk_source_valid": F.col("source").isin(ACTIVITY_SOURCES),
    }

# NOT NULL columns and primary keys of the three tables.
EMPLOYEE_NOT_NULL = ["employee_id", "last_name", "first_name", "birth_date", "business_unit", "hire_date", "gross_salary",
                     "contract_type", "paid_leave_days", "home_address", "transport_mode"]
ACTIVITY_NOT_NULL = ["activity_id", "employee_id", "sport_type", "start_at", "end_at", "duration_s", "source"]
SERVING_NOT_NULL = ["snapshot_date", "employee_id", "is_eligible_premium", "premium_amount", "activities_count_12m",
                    "is_eligible_wellbeing", "wellbeing_days", "wellbeing_cost", "total_cost"]
PRIMARY_KEYS = {
    "employees": ["employee_id"],
    "activities": ["activity_id"],
    "employee_eligibility": ["snapshot_date", "employee_id"],
}


def gold_suite(expected_rows: int | Column) -> list[quality.Rule]:
    """The five checks of the serving table."""
    return [
        quality.expect_row_count(expected_rows),
        quality.expect_between("total_cost", *QUALITY_TOTAL_COST_RANGE),
        quality.expect_between("gross_salary", *QUALITY_SALARY_RANGE),
        quality.expect_in_set("business_unit", BUSINESS_UNITS),
        quality.expect_not_null("employee_id"),
    ]


def activity_stream_suite() -> list[quality.Rule]:
    """Checks of the activity messages that add up over micro-batches."""
    return [
        quality.expect_not_null("activity_id"),
        quality.expect_not_null("employee_id"),
        quality.expect_not_null("sport_type"),
        quality.expect_in_set("source", ACTIVITY_SOURCES),
        quality.expect_between("duration_s", 1, 4 * 3600),
    ]
