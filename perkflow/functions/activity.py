"""Activity unit conversions and pace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_half_up


def metres_to_km(distance_m: Column) -> Column:
    return distance_m / F.lit(1000.0)


def seconds_to_minutes(duration_s: Column) -> Column:
    return duration_s / F.lit(60.0)


def pace_min_per_km(duration_min: Column, distance_km: Column) -> Column:
    """Minutes per km rounded to 2 decimals; NULL without a positive distance.

    The guard comes first so ANSI mode never sees a division by zero.
    """
    return F.when(distance_km.isNotNull() & (distance_km > 0), round_half_up(duration_min / distance_km, 2))
