"""Gold layer: per-employee mobility bonus and well-being days, with costs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BIKE_MODE, DEFAULT_PARAMETERS, LOOKBACK_DAYS, WALK_MODE
from ..functions.numeric import round_half_up
from .parameters import parameter_columns

# Columns of the eligibility table, in its order.
GOLD_COLUMNS = [
    "snapshot_date",
    "employee_id",
    "full_name",
    "business_unit",
    "contract_type",
    "gross_salary",
    "transport_mode",
    "home_to_office_km",
    "distance_check_status",
    "is_eligible_premium",
    "premium_amount",
    "activities_count_12m",
    "is_eligible_wellbeing",
    "wellbeing_days",
    "wellbeing_cost",
    "total_cost",
]


def lookback_start(as_of: dt.date, days: int) -> Column:
    """Inclusive lower bound ``as_of - days`` (a date; compared at midnight)."""
    return F.date_sub(F.lit(as_of), days)


def in_lookback(activities: DataFrame, as_of: dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Activities that started on or after ``as_of - days``. No upper bound:
    activities dated after ``as_of`` still count, as in the original job."""
    return activities.filter(F.col("start_at") >= lookback_start(as_of, days))


def rolling_window_count(activities: DataFrame, as_of: dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """``employee_id, activities_count_12m`` over the look-back window.

    Partial counts are built before the shuffle, so a hot employee costs one
    row per map task, not its whole history in one reducer.
    """
    return (
        in_lookback(activities.select("employee_id", "start_at"), as_of, days)
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("activities_count_12m"))
    )


def with_activity_counts(employees: DataFrame, counts: DataFrame) -> DataFrame:
    """Left join that keeps employees without activity; their count is 0."""
    return employees.join(counts, "employee_id", "left").withColumn(
        "activities_count_12m", F.coalesce(F.col("activities_count_12m"), F.lit(0).cast("bigint"))
    )


def mobility_flag(transport_mode: Column, km: Column, max_km_by_mode: Mapping[str, Column]) -> Column:
    """True when the commute is short enough for the employee's mode.

    A mode without a rule, an unknown mode or an unknown distance gives False
    (never NULL: the serving column is NOT NULL).
    """
    limit = None
    for mode, max_km in max_km_by_mode.items():
        limit = F.when(transport_mode == mode, max_km) if limit is None else limit.when(transport_mode == mode, max_km)
    return F.coalesce(km.isNotNull() & (km <= limit), F.lit(False))


def mode_limits(p: Mapping[str, Column]) -> dict[str, Column]:
    return {WALK_MODE: p["max_distance_walk_km"], BIKE_MODE: p["max_distance_bike_km"]}


def apply_benefit_rules(df: DataFrame, p: Mapping[str, Column]) -> DataFrame:
    """Adds the flags and amounts. Money is rounded half up to cents."""
    salary = F.col("gross_salary")
    flags = df.withColumns(
        {
            "is_eligible_premium": mobility_flag(
                F.col("transport_mode"), F.col("home_to_office_km"), mode_limits(p)
            ),
            "is_eligible_wellbeing": F.col("activities_count_12m") >= p["wellbeing_threshold"],
        }
    )
    amounts = flags.withColumns(
        {
            "premium_amount": F.when(
                F.col("is_eligible_premium"), round_half_up(salary * p["premium_rate"])
            ).otherwise(F.lit(0.0)),
            "wellbeing_days": F.when(
                F.col("is_eligible_wellbeing"), p["wellbeing_days"].cast("int")
            ).otherwise(F.lit(0)),
            "wellbeing_cost": F.when(
                F.col("is_eligible_wellbeing"), round_half_up(salary / F.lit(365.0) * p["wellbeing_days"])
            ).otherwise(F.lit(0.0)),
        }
    )
    return amounts.withColumn("total_cost", round_half_up(F.col("premium_amount") + F.col("wellbeing_cost")))


def employee_eligibility(
    employees_silver: DataFrame,
    activities: DataFrame,
    as_of: dt.date,
    params: Mapping[str, object] | DataFrame = DEFAULT_PARAMETERS,
    days: int = LOOKBACK_DAYS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The gold table: one row per employee of the snapshot.

    ``employees_silver`` needs employee_id, full_name, business_unit,
    contract_type, gross_salary, transport_mode, home_to_office_km,
    distance_check_status; ``activities`` needs employee_id and start_at.
    ``params`` is a mapping of values or a dated parameter table. ``counts``:
    the look-back counts if they are kept elsewhere (``plans.rolling``);
    ``activities`` isn't read then.
    """
    p = parameter_columns(params, as_of)
    counts = rolling_window_count(activities, as_of, days) if counts is None else counts
    emp = employees_silver.select(
        "employee_id",
        "full_name",
        "business_unit",
        "contract_type",
        F.col("gross_salary").cast("double").alias("gross_salary"),
        "transport_mode",
        "home_to_office_km",
        "distance_check_status",
    )
    df = apply_benefit_rules(with_activity_counts(emp, counts), p)
    return df.withColumn("snapshot_date", F.lit(as_of)).select(*GOLD_COLUMNS)
