"""Silver and gold of a day without a shuffle per join: both sides are bucketed by employee.

``keyed/employees/extract_date=D`` and ``keyed/activities/extract_date=D/is_hot=0``
are bucketed alike (:mod:`..sinks.bucketed`), so the names join and the count
join meet bucket by bucket. ``is_hot=1`` holds the activities of employees with
more than an even bucket's share, and those without an employee: they keep
their input splits, and their side of a join is a broadcast of fewer than
``buckets`` rows.

The layout costs one shuffle of the day's bronze activities, instead of one per
join; it is rerun-safe like any other layer (staged, then swapped in).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOOKBACK_DAYS
from ..operators import eligibility, refine
from ..sinks.bucketed import hot_keys, is_hot, open_bucketed, write_bucketed
from ..sinks.lake import swap_in
from ..sources import folders

KEY = "employee_id"


def _day(root: str, table: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{table}/extract_date={day}"


def _staged(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/.staging-{uuid.uuid4().hex[:12]}"


def lay_out_employees(spark: SparkSession, employees: DataFrame, root: str, day: dt.date, buckets: int) -> None:
    """Bucket the day's silver employees (one row per key: no hot keys)."""
    staged = _staged(root, "employees")
    write_bucketed(employees, staged, KEY, buckets)
    swap_in(spark, staged, _day(root, "employees", day))


def lay_out_activities(spark: SparkSession, activities: DataFrame, root: str, day: dt.date, buckets: int) -> list:
    """Bucket the day's activities, hot and unknown employees apart; returns the hot ids (fewer than ``buckets``)."""
    hot, staged = hot_keys(activities, KEY, buckets), _staged(root, "activities")
    apart = is_hot(KEY, hot)
    write_bucketed(activities.where(~apart), f"{staged}/is_hot=0", KEY, buckets)
    activities.where(apart).write.parquet(f"{staged}/is_hot=1")
    swap_in(spark, staged, _day(root, "activities", day))
    return hot


def employees_of(spark: SparkSession, root: str, day: dt.date, buckets: int) -> DataFrame:
    return open_bucketed(spark, _day(root, "employees", day), KEY, buckets)


def activities_of(spark: SparkSession, root: str, day: dt.date, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(bucketed, hot) activities of the day."""
    path = _day(root, "activities", day)
    if not folders.exists(spark, path):
        raise FileNotFoundError(f"activities of {day} aren't laid out: {path}")
    return open_bucketed(spark, f"{path}/is_hot=0", KEY, buckets), spark.read.parquet(f"{path}/is_hot=1")


def _of_hot(employees: DataFrame, hot: DataFrame) -> DataFrame:
    """Employees that the hot activities name: fewer rows than buckets, so safe to broadcast."""
    ids = hot.where(F.col(KEY).isNotNull()).select(KEY).distinct()
    return employees.join(F.broadcast(ids), KEY, "left_semi")


def activities_silver(employees: DataFrame, cold: DataFrame, hot: DataFrame, as_of: dt.date) -> DataFrame:
    """Silver activities: bucketed rows meet their employee in place, hot rows by broadcast."""
    in_place = refine.activities_silver(cold, employees, as_of)
    names = refine.employee_names(_of_hot(employees, hot))
    return in_place.unionByName(refine.activities_silver(hot, F.broadcast(names), as_of))


def with_activity_counts(employees: DataFrame, cold: DataFrame, hot: DataFrame, as_of: dt.date,
                         days: int = LOOKBACK_DAYS) -> DataFrame:
    """``employee_id, activities_count_12m`` of every employee, 0 without activity.

    Bucketed activities are counted and joined in place. Hot ones are
    pre-aggregated: their shuffle carries one row per hot employee and task.
    """
    counted = eligibility.with_activity_counts(employees.select(KEY), eligibility.rolling_window_count(cold, as_of, days))
    few = eligibility.rolling_window_count(hot.where(F.col(KEY).isNotNull()), as_of, days)
    few = few.withColumnRenamed("activities_count_12m", "hot_count")
    joined = counted.join(F.broadcast(few), KEY, "left")
    return joined.select(KEY, F.coalesce("hot_count", "activities_count_12m").alias("activities_count_12m"))


def employee_eligibility(employees: DataFrame, cold: DataFrame, hot: DataFrame, as_of: dt.date, params,
                         days: int = LOOKBACK_DAYS) -> DataFrame:
    """The gold table from tables laid out by employee."""
    counts = with_activity_counts(employees, cold, hot, as_of, days)
    return eligibility.employee_eligibility(employees, cold, as_of, params, days, counts)
