"""Activity counts over a moving look-back, kept by day buckets instead of counted anew.

Two tables below a root folder:

* ``buckets/arrived_on=A/start_day=S``: activities per employee that arrived on
  day A and started on day S (``employee_id, n``);
* ``totals/as_of=D``: activities per employee in the look-back of day D.

The window of D moves from that of the newest earlier day P by adding what has
arrived since P and subtracting the days that it has left behind:

    total(D) = total(P) + arrived in (P, D], start >= D - days
                        - arrived up to P, start in [P - days, D - days)

so a day reads the last total, its own arrivals and the bucket that leaves,
not the whole look-back. Late activities come in with the day that they
arrive, in whatever bucket they start. As in the full count the window has no
upper bound: activities that start after D count.

A day is rerun by calling :func:`advance` again (its buckets and total are
replaced); days after it then have to be rerun too, in order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOOKBACK_DAYS
from ..sinks.lake import replace_partition
from ..sources import folders

BUCKET_SCHEMA = "employee_id long, n long, arrived_on date, start_day date"
TOTAL_SCHEMA = "employee_id long, n long, as_of date"


def write_buckets(arrived: DataFrame, root: str, day: dt.date) -> None:
    """Count the activities that arrived on ``day`` (``employee_id, start_at``) into their buckets, replacing the day's."""
    counted = arrived.groupBy(F.col("employee_id").cast("long").alias("employee_id"), F.to_date("start_at").alias("start_day"))
    counted = counted.agg(F.count(F.lit(1)).alias("n")).where("start_day IS NOT NULL")
    counted.write.mode("overwrite").partitionBy("start_day").parquet(f"{root}/buckets/arrived_on={day}")


def buckets(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BUCKET_SCHEMA).option("basePath", f"{root}/buckets").parquet(f"{root}/buckets")


def totals(spark: SparkSession, root: str, as_of: dt.date) -> DataFrame:
    """``employee_id, activities_count_12m`` of a day that has been advanced to."""
    rows = spark.read.schema(TOTAL_SCHEMA).parquet(f"{root}/totals").where(F.col("as_of") == F.lit(as_of))
    return rows.select("employee_id", F.col("n").alias("activities_count_12m"))


def moved_window(spark: SparkSession, root: str, as_of: dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """``employee_id, n`` of ``as_of``: the newest earlier total moved on, or all buckets counted if there is none."""
    earlier = [d for d in map(dt.date.fromisoformat, folders.values_below(spark, f"{root}/totals", "as_of")) if d < as_of]
    first = as_of - dt.timedelta(days=days)
    rows, arrived, start = buckets(spark, root), F.col("arrived_on"), F.col("start_day")
    inside = (arrived <= F.lit(as_of)) & (start >= F.lit(first))
    if not earlier:
        moved = rows.where(inside).select("employee_id", "n")
    else:
        last = max(earlier)
        left = last - dt.timedelta(days=days)
        added = rows.where(inside & (arrived > F.lit(last))).select("employee_id", "n")
        gone = rows.where((arrived <= F.lit(last)) & (start >= F.lit(left)) & (start < F.lit(first)))
        before = totals(spark, root, last).select("employee_id", F.col("activities_count_12m").alias("n"))
        moved = before.unionByName(added).unionByName(gone.select("employee_id", (-F.col("n")).alias("n")))
    return moved.groupBy("employee_id").agg(F.sum("n").alias("n")).where("n <> 0")


def advance(spark: SparkSession, arrived: DataFrame, root: str, as_of: dt.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Take in the activities that arrived on ``as_of``, write that day's total and return it."""
    write_buckets(arrived, root, as_of)
    total = moved_window(spark, root, as_of, days).withColumn("as_of", F.lit(as_of))
    replace_partition(total, f"{root}/totals", "as_of", as_of)
    return totals(spark, root, as_of)
