"""Look-back counts moved on from day to day equal the full count."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perkflow.constants import TEST_AS_OF
from perkflow.operators import eligibility
from perkflow.plans import medallion, rolling
from perkflow.sources import testbed as tb
from perkflow.operators.enrichment import StoredReplies

from .conftest import SF_SMALL

DAYS = 10


def activities(spark):
    return tb.activities(spark, SF_SMALL).withColumn("arrived_on", tb.arrival_day()).persist()


def full_count(a, day):
    came = a.where(F.col("arrived_on") <= F.lit(day))
    return {r.employee_id: r.activities_count_12m for r in eligibility.rolling_window_count(came, day, DAYS).collect()}


def counted(df):
    return {r.employee_id: r.activities_count_12m for r in df.collect()}



def test_thirty_days_in_a_row(spark, scratch):
    a = activities(spark)
    for n in range(30):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        total = rolling.advance(spark, a.where(F.col("arrived_on") == F.lit(day)), scratch, day, DAYS)
        assert counted(total) == full_count(a, day), day
    late = a.where((F.col("arrived_on") > F.to_date("start_at")) & (F.col("arrived_on") <= F.lit(day))).count()
    assert late > 20
    a.unpersist()


def test_a_day_reads_its_arrivals_the_bucket_that_leaves_and_the_last_total(spark, scratch):
    a = activities(spark)
    for d in range(10, 25):
        day = dt.date(2024, 1, d)
        came = F.col("arrived_on") <= F.lit(day) if d == 10 else F.col("arrived_on") == F.lit(day)
        rolling.advance(spark, a.where(came), scratch, day, DAYS)
    day = dt.date(2024, 1, 25)
    rolling.write_buckets(a.where(F.col("arrived_on") == F.lit(day)), scratch, day)
    moved = rolling.moved_window(spark, scratch, day, DAYS)
    moved.collect()
    scans = moved._jdf.queryExecution().executedPlan().toString()
    assert scans.count("PartitionFilters: [isnotnull(") >= 3 and "PartitionFilters: []" not in scans
    # what Spark's pruned listing leaves of each scan, by the same conditions
    rows = rolling.buckets(spark, scratch)
    added = rows.where((F.col("arrived_on") > F.lit(dt.date(2024, 1, 24))) & (F.col("arrived_on") <= F.lit(day)))
    assert {r.arrived_on for r in added.select("arrived_on").distinct().collect()} == {day}
    gone = rows.where((F.col("start_day") >= F.lit(dt.date(2024, 1, 14))) & (F.col("start_day") < F.lit(dt.date(2024, 1, 15))))
    assert {r.start_day for r in gone.select("start_day").distinct().collect()} == {dt.date(2024, 1, 14)}
    a.unpersist()


def test_reruns_gaps_and_days_without_arrivals(spark, scratch):
    a = activities(spark)

    def go(d, upto=None):
        day = dt.date(2024, 1, d)
        first = dt.date(2024, 1, upto or d)
        came = (F.col("arrived_on") <= F.lit(day)) & (F.col("arrived_on") >= F.lit(first))
        return counted(rolling.advance(spark, a.where(came), scratch, day, DAYS)), full_count(a, day)

    for got, want in (go(12, 1), go(13), go(13), go(17, 14), go(18)):
        assert got == want
    empty = rolling.advance(spark, a.limit(0), scratch, dt.date(2024, 2, 20), DAYS)
    assert counted(empty) == {}  # everything has left the window
    a.unpersist()


def test_activities_after_the_day_count_and_missing_starts_do_not(spark, scratch):
    rows = [(1, dt.datetime(2024, 1, 5)), (1, dt.datetime(2024, 3, 1)), (2, None), (None, dt.datetime(2024, 1, 6))]
    df = spark.createDataFrame(rows, "employee_id long, start_at timestamp_ntz")
    day = dt.date(2024, 1, 7)
    assert counted(rolling.advance(spark, df, scratch, day, DAYS)) == {1: 2, None: 1}
    assert counted(rolling.advance(spark, df.limit(0), scratch, dt.date(2024, 1, 20), DAYS)) == {1: 1}


@pytest.mark.parametrize("days", [10])
def test_gold_from_moved_counts(spark, scratch, days):
    """The daily run gives the same gold table from moved counts as from a full count."""
    paths = medallion.LakePaths(f"{scratch}/lake")
    provider = StoredReplies(tb.distance_replies(spark, SF_SMALL))
    emp, act = tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL)
    before = dt.date(2024, 1, 25)
    old = F.to_date("start_at") <= F.lit(before)
    rolling.advance(spark, act.where(old), paths.table("gold", "activity_window"), before, days)
    medallion.run_daily(spark, emp, act, paths, TEST_AS_OF, provider, days=days, arrived=act.where(~old))
    moved = sorted(map(str, medallion.read_gold(spark, paths, TEST_AS_OF).collect()))
    medallion.run_gold(spark, paths, TEST_AS_OF, days=days)
    assert sorted(map(str, medallion.read_gold(spark, paths, TEST_AS_OF).collect())) == moved
