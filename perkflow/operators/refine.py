"""Silver layer: typed, enriched employees and activities."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.activity import metres_to_km, pace_min_per_km, seconds_to_minutes
from ..functions.people import completed_years, full_name
from .enrichment import enrich_distances, with_distances

EMPLOYEE_SILVER_COLUMNS = [
    "employee_id",
    "full_name",
    "first_name",
    "last_name",
    "birth_date",
    "business_unit",
    "hire_date",
    "gross_salary",
    "contract_type",
    "paid_leave_days",
    "home_address",
    "transport_mode",
    "home_to_office_km",
    "distance_check_status",
    "age",
    "seniority_years",
    "extract_date",
]

ACTIVITY_SILVER_COLUMNS = [
    "activity_id",
    "employee_id",
    "full_name",
    "business_unit",
    "sport_type",
    "start_at",
    "end_at",
    "distance_km",
    "duration_min",
    "comment",
    "source",
    "pace_min_per_km",
    "extract_date",
]


def employees_silver(employees: DataFrame, provider, as_of: dt.date, cache: DataFrame | None = None,
                     resolved: DataFrame | None = None) -> DataFrame:
    """Bronze employees -> refined employees (distance, age, seniority, types).

    ``resolved`` (``home_address, home_to_office_km, distance_check_status``)
    skips the provider: pass a table of addresses resolved earlier.
    """
    if resolved is not None:
        e = with_distances(employees, resolved)
    else:
        e = enrich_distances(employees, provider, cache)
    return e.select(
        F.col("employee_id"),
        full_name("first_name", "last_name").alias("full_name"),
        "first_name",
        "last_name",
        F.col("birth_date").cast("date").alias("birth_date"),
        "business_unit",
        F.col("hire_date").cast("date").alias("hire_date"),
        F.col("gross_salary").cast("double").alias("gross_salary"),
        "contract_type",
        F.col("paid_leave_days").cast("int").alias("paid_leave_days"),
        "home_address",
        "transport_mode",
        "home_to_office_km",
        "distance_check_status",
        completed_years(as_of, "birth_date").alias("age"),
        completed_years(as_of, "hire_date").alias("seniority_years"),
        F.lit(as_of).alias("extract_date"),
    )


def employee_names(employees: DataFrame) -> DataFrame:
    """``employee_id, full_name, business_unit`` from either bronze or silver employees."""
    if "full_name" in employees.columns:
        return employees.select("employee_id", "full_name", "business_unit")
    return employees.select("employee_id", full_name("first_name", "last_name").alias("full_name"), "business_unit")


def activities_silver(activities: DataFrame, employees: DataFrame, as_of: dt.date) -> DataFrame:
    """Bronze activities -> refined activities (name, unit, km, minutes, pace).

    Left join: an activity of an unknown employee is kept with NULL name.
    The employee side is unique per key; a hot employee on the activity side
    is split by AQE's skew-join handling, or the small side is broadcast when
    Spark's size estimate allows it.
    """
    names = employee_names(employees)
    a = activities.join(names, "employee_id", "left")
    km = metres_to_km(F.col("distance_m"))
    minutes = seconds_to_minutes(F.col("duration_s"))
    return a.select(
        "activity_id",
        "employee_id",
        "full_name",
        "business_unit",
        "sport_type",
        "start_at",
        "end_at",
        km.alias("distance_km"),
        minutes.alias("duration_min"),
        "comment",
        "source",
        pace_min_per_km(minutes, km).alias("pace_min_per_km"),
        F.lit(as_of).alias("extract_date"),
    )
