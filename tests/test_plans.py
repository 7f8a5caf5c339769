"""Physical plan properties that matter at scale."""

import pytest

from perkflow.plans.catalog import REGISTRY as QUERIES

from .conftest import SF_SMALL

CDC_KEYS = ["cdc_parse_json", "cdc_live_filter", "cdc_unwrap", "cdc_current_state", "event_name_lookup",
            "notification_messages", "dead_letter", "notification_outbox", "not_null_violations"]


def _plan(df):
    """Physical plan of a fresh projection (an executed DataFrame would print
    AQE's final and initial plans together)."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_pair_explosion(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_window_filter_pushed_and_partial_count(spark):
    plan = _plan(QUERIES["rolling_window_count"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-21T00:00)" in plan
    assert "partial_count" in plan


def test_gold_prunes_unused_inputs(spark):
    plan = _plan(QUERIES["employee_eligibility"](spark, SF_SMALL))
    assert "orders.parquet" not in plan  # hire dates are not needed for gold
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_json_parsed_once_per_row(spark):
    for key in ("notification_messages", "cdc_live_filter", "cdc_current_state", "distance_reply_decode",
                "distance_enrichment"):
        plan = _plan(QUERIES[key](spark, SF_SMALL))
        assert plan.count("from_json") == 1, key


def test_current_state_aggregates_before_shuffle(spark):
    plan = _plan(QUERIES["cdc_current_state"](spark, SF_SMALL))
    assert "partial_max_by" in plan
    assert "Window" not in plan


def test_hot_employee_is_split_not_dropped(spark):
    """One employee owns a third of the activities and the employee side is
    not broadcast: the join is split by the skew handling, rows stay whole."""
    import datetime as dt

    from pyspark.sql import functions as F

    from perkflow.operators import refine

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 900_000
        acts = spark.range(n).select(
            F.col("id").alias("activity_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("employee_id"),
            F.lit("Yoga").alias("sport_type"),
            F.lit(None).cast("timestamp_ntz").alias("start_at"),
            F.lit(None).cast("timestamp_ntz").alias("end_at"),
            F.lit(None).cast("int").alias("distance_m"),
            F.lit(600).alias("duration_s"),
            F.lit(None).cast("string").alias("comment"),
            F.lit("live").alias("source"),
        )
        emp = spark.range(5000).select(
            F.col("id").alias("employee_id"), F.lit("A").alias("first_name"), F.col("id").cast("string").alias("last_name"),
            F.lit("Finance").alias("business_unit"),
        )
        out = refine.activities_silver(acts, emp, dt.date(2024, 1, 31))
        assert out.rdd.count() == n
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("key", CDC_KEYS)
def test_no_round_robin_shuffle(spark, key):
    assert "RoundRobinPartitioning" not in _plan(QUERIES[key](spark, SF_SMALL))


def test_snapshot_as_of_reads_one_folder(spark):
    plan = _plan(QUERIES["snapshot_as_of"](spark, SF_SMALL))
    assert "Subquery" not in plan and plan.count("Scan parquet") == 1
    assert "PartitionFilters: [isnotnull(extract_date" in plan


def test_parameter_window_gets_aggregated_days(spark):
    """The window without a partition key sits on distinct days, not on activities."""
    plan = _plan(QUERIES["latest_parameters"](spark, SF_SMALL))
    assert plan.index("Window") < plan.index("HashAggregate(keys=[_at") < plan.index("events.parquet")


def test_insert_ignore_narrows_only_the_write(spark, monkeypatch):
    """Eight connections write; the anti-join keeps its own parallelism."""
    from pyspark.sql import DataFrameWriter

    from perkflow.sinks import jdbc

    seen = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, **k: seen.append(self._df))
    jdbc.append(spark.range(1000).repartition(37, "id").groupBy("id").count(), "jdbc:x", "T", {}, num_partitions=5)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(5)" in plan and "Coalesce" not in plan
    assert "hashpartitioning(id" in plan
