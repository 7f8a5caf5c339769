"""Quality rules observed on micro-batches: sums equal the batch suite, replays count once."""

import pytest
from pyspark.sql import functions as F

from perkflow.operators import quality
from perkflow.streaming import batch_quality as bq

SCHEMA = "id long, v int, s string"
PARTS = [[(1, 5, "a"), (None, 12, "b")], [(None, None, None)], [(3, -1, "x"), (4, 9, "a"), (5, 0, None)]]


def rules():
    return [quality.expect_not_null("id"), quality.expect_between("v", 0, 9), quality.expect_in_set("s", ["a", "b"])]


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(spark, scratch):
    q = bq.start_checked_stream(stream(spark, f"{scratch}/in"), rules(), f"{scratch}/rows", f"{scratch}/reports",
                                f"{scratch}/check", available_now=True)
    q.awaitTermination()


def totals(spark, scratch):
    return sorted(map(tuple, bq.stream_report(bq.batch_reports(spark, f"{scratch}/reports")).collect()))


def suite(spark, parts):
    df = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    return sorted(map(tuple, quality.run_suite(df, rules()).collect()))


def test_sums_of_batches_equal_the_suite_and_go_on_after_a_restart(spark, scratch):
    for p in PARTS[:2]:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    drain(spark, scratch)
    assert totals(spark, scratch) == suite(spark, PARTS[:2])
    spark.createDataFrame(PARTS[2], SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    drain(spark, scratch)
    assert totals(spark, scratch) == suite(spark, PARTS)
    assert bq.batch_reports(spark, f"{scratch}/reports").select("batch_id").distinct().count() == 3
    assert spark.read.schema(SCHEMA).parquet(f"{scratch}/rows").count() == 6


def test_a_replayed_batch_counts_once_and_an_empty_one_nothing(spark, scratch):
    process = bq.quality_writer(rules(), f"{scratch}/rows", f"{scratch}/reports")
    df = spark.createDataFrame(PARTS[0] + PARTS[2], SCHEMA)
    process(df.limit(2), 0)  # the driver died here and the batch comes again, whole
    process(df, 0)
    process(df.where(F.lit(False)), 1)
    assert totals(spark, scratch) == suite(spark, [PARTS[0], PARTS[2]])
    empty = bq.batch_reports(spark, f"{scratch}/reports").where("batch_id = 1").select("evaluated", "failed", "success")
    assert [tuple(r) for r in empty.collect()] == [(0, 0, True)] * 3


def test_counted_in_the_same_pass(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame(PARTS[2], SCHEMA).mapInArrow(seen, SCHEMA)
    rows = bq.write_observed(df, rules(), lambda d: d.write.format("noop").mode("overwrite").save())
    assert [r[3:5] for r in rows] == [(3, 0), (3, 1), (2, 1)] and reads.value == 3


def test_rules_that_do_not_add_up_are_refused(spark):
    for refused in ([], [quality.expect_row_count(3)]):
        with pytest.raises(ValueError):
            bq.quality_writer(refused, "r", "q")
