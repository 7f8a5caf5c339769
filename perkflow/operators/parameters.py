"""Benefit parameters: pick the row in force and expose it to a plan.

The parameter row is injected as a scalar subquery (one row by construction),
so one physical plan serves any parameter set, nothing is collected to the
driver and no join is needed to attach it to the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAMETER_FIELDS = [
    "premium_rate",
    "wellbeing_threshold",
    "wellbeing_days",
    "max_distance_walk_km",
    "max_distance_bike_km",
]


def latest_parameters(history: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest parameter row dated on or before ``as_of`` (at most one row).

    ``snapshot_date`` is the primary key, so there are no ties. A top-1 sort
    runs as a per-partition top-k followed by a one-row merge.
    """
    return history.filter(F.col("snapshot_date") <= F.lit(as_of)).orderBy(F.col("snapshot_date").desc()).limit(1)


def parameters_in_force(days: DataFrame, history: DataFrame, day_col: str = "day") -> DataFrame:
    """For every distinct day, the newest parameter row dated on or before it
    (NULL parameters before the first row): :func:`latest_parameters` for a
    whole series of as-of dates at once.

    Days and parameter rows are merged in date order and the last parameter
    row seen is carried forward (``last(..., ignorenulls)``), so no day is
    ever paired with every parameter row. The window has no partition key:
    its input is the distinct calendar days plus the parameter versions,
    which stays small whatever the data volume.
    """
    rows = history.select(
        F.col("snapshot_date").alias("_at"), F.struct(*history.columns).alias("_row"), F.lit(0).alias("_is_day")
    )
    row_type = rows.schema["_row"].dataType
    marks = days.select(F.col(day_col).cast("date").alias("_at")).distinct().select(
        "_at", F.lit(None).cast(row_type).alias("_row"), F.lit(1).alias("_is_day")
    )
    w = Window.orderBy("_at", "_is_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = rows.unionByName(marks).withColumn("_in_force", F.last("_row", ignorenulls=True).over(w))
    return merged.filter(F.col("_is_day") == 1).select(F.col("_at").alias(day_col), "_in_force.*")


def parameter_columns(params: Mapping[str, object] | DataFrame, as_of: dt.date | None = None) -> dict[str, Column]:
    """Parameter name -> Column.

    ``params`` is either a mapping of plain values (used as literals) or a
    parameter history table, reduced with :func:`latest_parameters` and read
    through one scalar subquery. A history without a row in force fails the
    query with an explicit error instead of silently computing with NULLs.
    """
    if isinstance(params, DataFrame):
        if as_of is None:
            raise ValueError("as_of is required with a parameter table")
        row = latest_parameters(params, as_of).select(F.struct(*PARAMETER_FIELDS).alias("p")).scalar()
        checked = F.when(
            row.isNull(), F.raise_error(F.lit(f"no benefit parameters in force on {as_of}"))
        ).otherwise(row)
        return {f: checked.getField(f) for f in PARAMETER_FIELDS}
    missing = [f for f in PARAMETER_FIELDS if f not in params]
    if missing:
        raise ValueError(f"missing parameters: {missing}")
    return {f: F.lit(params[f]) for f in PARAMETER_FIELDS}
