"""Truncates as epochs of the current state, and a stream whose state forgets deletes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from perkflow.operators import cdc
from perkflow.streaming import current_state as cs
from perkflow.streaming.notifier import file_source

DAY = 86_400_000
KEY = ["employee_id"]


def envelope(lsn, op, key=None, salary=1.0, day=0):
    image = None if key is None else {"employee_id": key, "business_unit": f"u{lsn}", "gross_salary": salary}
    sides = {"before": image if op in "ud" else None, "after": image if op != "d" else None}
    return (lsn, json.dumps({**sides, "op": op, "source": {"ts_ms": day * DAY + lsn, "lsn": lsn}}))


LOG = [
    envelope(1, "c", 1), envelope(2, "c", 2), envelope(3, "u", 1), envelope(4, "t"), envelope(5, "c", 2), envelope(6, "c", 3), envelope(7, "d", 3),
    envelope(8, "c", 4), envelope(9, "t"), envelope(10, "u", 4), envelope(11, "c", 5), envelope(12, "d", 5), envelope(13, "c", 6), envelope(14, "c"),
]


def table(spark, log):
    return spark.createDataFrame(log, "key long, value string").repartition(3)


def state(df):
    return {r.employee_id: r["__source_lsn"] for r in df.collect()}


@pytest.mark.parametrize(("upto", "want"), [(3, {1: 3, 2: 2}), (4, {}), (8, {2: 5, 4: 8}), (9, {}), (14, {4: 10, 6: 13})])
def test_changes_up_to_a_truncate_do_not_count(spark, upto, want):
    changes = cdc.unwrap_envelopes(table(spark, LOG[:upto]))
    assert state(cdc.current_state(changes, KEY)) == want


def test_truncates_of_composite_keys(spark):
    rows = [("a", 1, "c", 1), ("a", None, "c", 2), (None, None, "t", 3), ("a", 1, "c", 4), ("b", 2, "c", 2), ("a", None, "t", 2)]
    df = spark.createDataFrame(rows, "x string, y long, __op string, __source_lsn long").withColumn("__source_ts_ms", F.lit(0)).withColumn("__deleted", F.lit(False))
    assert [(r.x, r.y, r["__source_lsn"]) for r in cdc.current_state(df, ["x", "y"]).collect()] == [("a", 1, 4)]


def test_the_epoch_is_one_number_in_the_plan(spark):
    changes = cdc.unwrap_envelopes(table(spark, LOG))
    assert cdc.newest_truncate(changes) == 9 and cdc.newest_truncate(changes.limit(0)) is None
    plan = cdc.current_state(changes, KEY)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Window", "CartesianProduct", "Subquery", "Join"))


def feed(spark, scratch, name, files, start, **options):
    """One file per run of the stream, in order; updates land in one folder."""
    base = f"{scratch}/{name}"
    schema = "key long, value string"
    queries = []
    for log in files:
        spark.createDataFrame(log, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        changes = cdc.unwrap_envelopes(file_source(spark, f"{base}/in", spark.createDataFrame([], schema).schema))
        q = start(changes, KEY, f"{base}/updates", f"{base}/c", available_now=True, **options)
        q.awaitTermination()
        assert q.exception() is None
        queries.append(q)
    return f"{base}/updates", queries


@pytest.mark.parametrize("start", [cs.start_state_stream, cs.start_ttl_state_stream])
def test_streams_equal_the_batch(spark, scratch, start):
    files = [LOG[:2], LOG[2:6], LOG[6:9], [LOG[12], LOG[9]], [LOG[10], LOG[13], LOG[11]]]
    updates, _ = feed(spark, scratch, "s", files, start)
    want = {4: 10, 6: 13}
    assert state(cs.read_state(spark, updates, KEY)) == want
    cs.compact_state(spark, updates, KEY, upto=2)
    assert state(cs.read_state(spark, updates, KEY)) == want
    cs.compact_state(spark, updates, KEY)
    assert state(cs.read_state(spark, updates, KEY)) == want


def test_deletes_leave_the_state_and_stay_deleted(spark, scratch):
    late = [envelope(50, "u", 1, day=1)]
    files = [
        [envelope(60, "c", 1, day=1), envelope(61, "c", 2, day=1)],
        [envelope(70, "d", 1, day=2)],
        [envelope(65, "u", 1, day=1)],  # older than the delete, which the state still knows
        [envelope(80, "u", 2, day=20)],  # moves the watermark to day 18: the delete is forgotten
        [envelope(81, "u", 2, day=20)],
        late,  # older than the watermark
        [envelope(90, "c", 3, day=21)],
    ]
    updates, queries = feed(spark, scratch, "ttl", files, cs.start_ttl_state_stream, ttl=dt.timedelta(days=7), delay="2 days")
    assert state(cs.read_state(spark, updates, KEY)) == {2: 81, 3: 90}
    rows = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in queries]
    written = {r["__source_lsn"] for r in cs._updates(spark, updates).collect()}
    assert written == {60, 61, 70, 80, 81, 90}
    assert rows[2] > rows[-1] - 1, rows


def test_a_key_may_come_back_by_a_newer_change(spark, scratch):
    files = [[envelope(1, "c", 1)], [envelope(2, "d", 1)], [envelope(3, "c", 1)]]
    updates, _ = feed(spark, scratch, "again", files, cs.start_ttl_state_stream)
    assert state(cs.read_state(spark, updates, KEY)) == {1: 3}
    assert spark.conf.get(cs.STATE_STORE, "") != cs.ROCKSDB
