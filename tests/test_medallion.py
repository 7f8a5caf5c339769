"""Daily bronze -> silver -> gold run: rerun-safe, days independent."""

import datetime as dt

from perkflow.operators.enrichment import StoredReplies
from perkflow.plans import medallion
from perkflow.sources import lake
from perkflow.sources import testbed as tb

from .conftest import SF_SMALL

DAY = dt.date(2024, 1, 31)


def test_rerun_and_next_day(spark, scratch):
    paths = medallion.LakePaths(scratch)
    emp, act = tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL)
    provider = StoredReplies(tb.distance_replies(spark, SF_SMALL))
    c1 = medallion.run_daily(spark, emp, act, paths, DAY, provider)
    g1 = sorted(tuple(r) for r in medallion.read_gold(spark, paths, DAY).collect())
    c2 = medallion.run_daily(spark, emp, act, paths, DAY, provider)
    g2 = sorted(tuple(r) for r in medallion.read_gold(spark, paths, DAY).collect())
    assert c1 == c2
    assert g1 == g2
    assert c1["gold.employee_eligibility"] == emp.count() == len(g1)
    assert c1["silver.activities"] == act.count()

    nxt = DAY + dt.timedelta(days=1)
    medallion.run_daily(spark, emp, act, paths, nxt, provider)  # reuses yesterday's distances
    gold = lake.read_table(spark, paths.table("gold", "employee_eligibility"))
    per_day = {r.snapshot_date: r["count"] for r in gold.groupBy("snapshot_date").count().collect()}
    assert per_day == {DAY: len(g1), nxt: len(g1)}
    assert sorted(tuple(r) for r in medallion.read_gold(spark, paths, DAY).collect()) == g1


def test_publish_gold_to_serving_table(spark, scratch):
    from perkflow.sources.jdbc import jdbc_scan

    url, props = "jdbc:derby:memory:perkflow_serving;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    paths = medallion.LakePaths(scratch)
    emp, act = tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL)
    medallion.run_daily(spark, emp, act, paths, DAY, StoredReplies(tb.distance_replies(spark, SF_SMALL)))
    medallion.publish_gold(spark, paths, DAY, url, "FCT_EMPLOYEE_ELIGIBILITY", props)
    medallion.publish_gold(spark, paths, DAY, url, "FCT_EMPLOYEE_ELIGIBILITY", props)  # rerun: replaced
    served = jdbc_scan(spark, url, "FCT_EMPLOYEE_ELIGIBILITY", props)
    assert served.count() == emp.count()
    types = dict(served.dtypes)
    assert (types["total_cost"], types["home_to_office_km"], types["activities_count_12m"]) == (
        "decimal(10,2)", "decimal(8,2)", "int")
    assert served.filter("is_eligible_premium").count() == medallion.read_gold(spark, paths, DAY).filter(
        "is_eligible_premium").count()


def test_next_day_reuses_resolved_addresses(spark, scratch):
    from perkflow.operators.enrichment import NoKeyProvider

    paths = medallion.LakePaths(scratch)
    emp, act = tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL)
    medallion.run_daily(spark, emp, act, paths, DAY, StoredReplies(tb.distance_replies(spark, SF_SMALL)))
    nxt = DAY + dt.timedelta(days=1)
    medallion.run_daily(spark, emp, act, paths, nxt, NoKeyProvider())  # service unavailable on day 2

    def statuses(day):
        g = medallion.read_gold(spark, paths, day)
        return {r.distance_check_status: r["count"] for r in g.groupBy("distance_check_status").count().collect()}

    d1, d2 = statuses(DAY), statuses(nxt)
    assert d2.get("ok") == d1.get("ok") and d2.get("not_found") == d1.get("not_found")  # from the cache
    assert "error" not in d2  # errors are asked again; without a service they become no_api_key
    assert d2["no_api_key"] == d1.get("no_api_key", 0) + d1.get("error", 0)


def test_gold_over_silver_prunes_and_pushes(spark, scratch):
    from perkflow.operators import eligibility

    paths = medallion.LakePaths(scratch)
    medallion.run_bronze(spark, tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL), paths, DAY)
    medallion.run_silver(spark, paths, DAY, StoredReplies(tb.distance_replies(spark, SF_SMALL)))
    emp = lake.snapshot_scan(spark, paths.table("silver", "employees"), DAY)
    act = lake.snapshot_scan(spark, paths.table("silver", "activities"), DAY)
    plan = eligibility.employee_eligibility(emp, act, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan
    assert "GreaterThanOrEqual(start_at,2023-01-31T00:00)" in plan


def test_address_cache_age_and_off_switch(spark, scratch):
    from perkflow.operators.enrichment import NoKeyProvider

    paths = medallion.LakePaths(scratch)
    emp, act = tb.employees(spark, SF_SMALL), tb.activities(spark, SF_SMALL)
    medallion.run_bronze(spark, emp, act, paths, DAY)
    medallion.run_silver(spark, paths, DAY, StoredReplies(tb.distance_replies(spark, SF_SMALL)))

    def statuses(day, **options):
        medallion.run_bronze(spark, emp, act, paths, day)
        medallion.run_silver(spark, paths, day, NoKeyProvider(), **options)
        rows = lake.snapshot_scan(spark, paths.table("silver", "addresses"), day)
        return {r.distance_check_status for r in rows.collect()}, {r.resolved_on for r in rows.collect()}

    day = lambda n: DAY + dt.timedelta(days=n)
    assert statuses(day(1), cache_days=2) == ({"ok", "not_found", "no_api_key"}, {DAY, day(1)})
    assert statuses(day(2), cache_days=2)[0] == {"ok", "not_found", "no_api_key"}  # the age counts from the asking
    assert statuses(day(3), cache_days=2) == ({"no_api_key"}, {day(3)})
    assert statuses(day(1), use_cache=False) == ({"no_api_key"}, {day(1)})


def test_broken_address_table_is_an_error(spark, scratch):
    import pytest

    paths = medallion.LakePaths(scratch)
    assert medallion.distance_cache(spark, paths, DAY) is None  # not there yet
    spark.createDataFrame([(1, DAY)], "x int, extract_date date").write.partitionBy("extract_date").parquet(
        paths.table("silver", "addresses"))
    with pytest.raises(Exception, match="resolved_on"):
        medallion.distance_cache(spark, paths, DAY + dt.timedelta(days=1))
