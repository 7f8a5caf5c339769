"""Daily bronze -> silver -> gold run over a lake folder.

Each layer is written as a daily partition and the next layer re-reads it, so
lineage is cut at every layer boundary (a lost executor recomputes from the
last written table, never from the sources) and every step is rerun-safe:
running a day twice replaces that day's partitions and leaves the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_PARAMETERS, DISTANCE_NOT_FOUND, DISTANCE_OK, LOOKBACK_DAYS
from ..operators import eligibility, refine
from ..operators.enrichment import RESOLVED_COLUMNS, resolve_addresses
from ..sinks import staged_jdbc
from ..sinks.lake import replace_partition, write_counted
from ..sources import folders, lake
from . import keyed, rolling
from .stamps import stamp

PART = "extract_date"
GOLD_PART = "snapshot_date"


@dataclass(frozen=True)
class LakePaths:
    """Lake root and table format (``parquet``, or ``delta`` when its jar is
    on the classpath: atomic ``replaceWhere`` and time travel)."""

    root: str
    fmt: str = "parquet"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def _write_day(df: DataFrame, path: str, part: str, day: dt.date, name: str, fmt: str = "parquet") -> int:
    return write_counted(df, lambda d: replace_partition(d, path, part, day, fmt), name)


def run_bronze(spark: SparkSession, employees: DataFrame, activities: DataFrame, paths: LakePaths,
               as_of: dt.date) -> dict[str, int]:
    """Raw copies of the sources, stamped with the extract date."""
    return {
        "bronze.employees": _write_day(stamp(employees, as_of), paths.table("bronze", "employees"), PART, as_of,
                                       "bronze_employees", paths.fmt),
        "bronze.activities": _write_day(stamp(activities, as_of), paths.table("bronze", "activities"), PART, as_of,
                                        "bronze_activities", paths.fmt),
    }


#: Days after which a resolved address is asked again.
CACHE_DAYS = 30


def distance_cache(spark: SparkSession, paths: LakePaths, as_of: dt.date, max_age_days: int = CACHE_DAYS) -> DataFrame | None:
    """Addresses resolved on the newest earlier day and at most ``max_age_days``
    ago (ok / not_found only: errors are asked again), with ``resolved_on``.
    None when the table isn't there (first run)."""
    path = paths.table("silver", "addresses")
    if not folders.exists(spark, path):
        return None
    prev = lake.snapshot_as_of(spark, path, as_of - dt.timedelta(days=1), PART, paths.fmt)
    fresh = F.col("resolved_on") >= F.lit(as_of - dt.timedelta(days=max_age_days))
    known = F.col("distance_check_status").isin(DISTANCE_OK, DISTANCE_NOT_FOUND)
    return prev.filter(known & fresh).select(*RESOLVED_COLUMNS, "resolved_on")


def run_silver(spark: SparkSession, paths: LakePaths, as_of: dt.date, provider,
               use_cache: bool = True, cache_days: int = CACHE_DAYS, buckets: int | None = None) -> dict[str, int]:
    """Resolve addresses (written first, so the service is asked once per
    address and day even if a later stage is retried), then employees, then
    activities joined to the written employees. With ``buckets`` employees and
    activities are laid out by employee first (:mod:`.keyed`) and joined in
    place; ``run_gold`` needs the same number."""
    emp_bronze = lake.snapshot_scan(spark, paths.table("bronze", "employees"), as_of, PART, paths.fmt).drop(PART, "extract_ts")
    cache = distance_cache(spark, paths, as_of, cache_days) if use_cache else None
    resolved = resolve_addresses(emp_bronze, provider, cache)
    if cache is None:
        resolved = resolved.withColumn("resolved_on", F.lit(as_of))
    else:
        since = cache.select("home_address", "resolved_on")
        resolved = resolved.join(since, "home_address", "left").withColumn("resolved_on", F.coalesce("resolved_on", F.lit(as_of)))
    resolved = stamp(resolved, as_of)
    counts = {"silver.addresses": _write_day(resolved, paths.table("silver", "addresses"), PART, as_of,
                                             "silver_addresses", paths.fmt)}
    written = lake.snapshot_scan(spark, paths.table("silver", "addresses"), as_of, PART, paths.fmt)
    emp = stamp(refine.employees_silver(emp_bronze, None, as_of, resolved=written).drop(PART), as_of)
    counts["silver.employees"] = _write_day(emp, paths.table("silver", "employees"), PART, as_of,
                                            "silver_employees", paths.fmt)
    act_bronze = lake.snapshot_scan(spark, paths.table("bronze", "activities"), as_of, PART, paths.fmt).drop(PART, "extract_ts")
    emp_silver = lake.snapshot_scan(spark, paths.table("silver", "employees"), as_of, PART, paths.fmt)
    # Rows sorted by start time inside each write task (no shuffle): parquet
    # row-group min/max stats then let gold's look-back filter skip old groups.
    if buckets:
        root = paths.table("silver", "keyed")
        keyed.lay_out_employees(spark, emp_silver.drop(PART), root, as_of, buckets)
        keyed.lay_out_activities(spark, act_bronze, root, as_of, buckets)
        laid = keyed.employees_of(spark, root, as_of, buckets), *keyed.activities_of(spark, root, as_of, buckets)
        act_silver = keyed.activities_silver(*laid, as_of)
    else:
        act_silver = refine.activities_silver(act_bronze, emp_silver, as_of)
    act = stamp(act_silver.drop(PART), as_of).sortWithinPartitions("start_at")
    counts["silver.activities"] = _write_day(act, paths.table("silver", "activities"), PART, as_of,
                                             "silver_activities", paths.fmt)
    return counts


def run_gold(spark: SparkSession, paths: LakePaths, as_of: dt.date,
             params: Mapping[str, object] | DataFrame = DEFAULT_PARAMETERS,
             days: int = LOOKBACK_DAYS, arrived: DataFrame | None = None, buckets: int | None = None) -> dict[str, int]:
    """The eligibility table of the day. With ``buckets`` (as given to
    :func:`run_silver`) counts and join run in place, bucket by bucket. With ``arrived`` (the activities that
    came in on ``as_of``) the look-back counts are moved on from the last day's
    (:mod:`.rolling`) and silver activities aren't read."""
    counts = None
    if arrived is not None:
        counts = rolling.advance(spark, arrived, paths.table("gold", "activity_window"), as_of, days)
    if buckets and counts is None:
        root = paths.table("silver", "keyed")
        laid = keyed.employees_of(spark, root, as_of, buckets), *keyed.activities_of(spark, root, as_of, buckets)
        gold = keyed.employee_eligibility(*laid, as_of, params, days)
    else:
        emp = lake.snapshot_scan(spark, paths.table("silver", "employees"), as_of, PART, paths.fmt)
        act = lake.snapshot_scan(spark, paths.table("silver", "activities"), as_of, PART, paths.fmt)
        gold = eligibility.employee_eligibility(emp, act, as_of, params, days, counts)
    return {"gold.employee_eligibility": _write_day(gold, paths.table("gold", "employee_eligibility"), GOLD_PART,
                                                    as_of, "gold_eligibility", paths.fmt)}


def read_gold(spark: SparkSession, paths: LakePaths, as_of: dt.date) -> DataFrame:
    """The day's gold partition as written (what the serving export publishes)."""
    return lake.snapshot_scan(spark, paths.table("gold", "employee_eligibility"), as_of, GOLD_PART, paths.fmt)


# Column types of the serving table.
SERVING_TYPES = {
    "employee_id": "int",
    "gross_salary": "decimal(10,2)",
    "home_to_office_km": "decimal(8,2)",
    "premium_amount": "decimal(10,2)",
    "activities_count_12m": "int",
    "wellbeing_days": "int",
    "wellbeing_cost": "decimal(10,2)",
    "total_cost": "decimal(10,2)",
}


def serving_rows(gold: DataFrame) -> DataFrame:
    """Gold rows in the serving table's column types (money as NUMERIC(10,2),
    distance NUMERIC(8,2), counts INTEGER)."""
    return gold.select(
        *[F.col(c).cast(SERVING_TYPES[c]).alias(c) if c in SERVING_TYPES else F.col(c) for c in eligibility.GOLD_COLUMNS]
    )


def publish_gold(spark: SparkSession, paths: LakePaths, as_of: dt.date, url: str, table: str,
                 properties: Mapping[str, str]) -> None:
    """Serving export: the written gold partition (not a recomputation)
    replaces the serving table's content in one transaction, keeping its
    definition; a table created by the first publish gets the serving column
    types."""
    staged_jdbc.publish_staged(serving_rows(read_gold(spark, paths, as_of)), url, table, properties)


def run_daily(spark: SparkSession, employees: DataFrame, activities: DataFrame, paths: LakePaths,
              as_of: dt.date, provider, params: Mapping[str, object] | DataFrame = DEFAULT_PARAMETERS,
              days: int = LOOKBACK_DAYS, use_cache: bool = True, cache_days: int = CACHE_DAYS,
              arrived: DataFrame | None = None, buckets: int | None = None) -> dict[str, int]:
    """bronze >> silver >> gold for one day; returns rows written per table.
    ``use_cache`` False asks the provider for every address again; ``arrived``:
    see :func:`run_gold`; ``buckets``: see :func:`run_silver`."""
    counts = run_bronze(spark, employees, activities, paths, as_of)
    counts.update(run_silver(spark, paths, as_of, provider, use_cache, cache_days, buckets))
    counts.update(run_gold(spark, paths, as_of, params, days, arrived, buckets))
    return counts
