"""JDBC reads by ranges of equal numbers of rows, on the embedded database."""

import pytest
from pyspark.sql import functions as F

from perkflow.sources import jdbc

DERBY = "jdbc:derby:memory:perkflow_ranges;create=true"
PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def table(spark, name, ids):
    df = spark.createDataFrame([(i, f"v{i}") for i in ids], "ID long, V string").coalesce(1)
    df.write.mode("overwrite").jdbc(DERBY, name, properties=PROPS)
    return df


def sizes(df):
    per = dict(df.groupBy(F.spark_partition_id()).count().collect())
    return [per.get(i, 0) for i in range(df.rdd.getNumPartitions())]


def test_bunched_ids_are_read_evenly(spark):
    bunch = list(range(500_000, 500_000 + 900 * 11, 11))  # 90 % of the ids in 1 % of the range
    spread = list(range(0, 1_000_000, 10_000))
    df = table(spark, "BUNCHED", bunch + [i for i in spread if i not in set(bunch)])
    got = jdbc.jdbc_equi_depth_scan(spark, DERBY, "BUNCHED", PROPS, "ID", 8)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    even = sizes(got)
    assert len(even) == 8 and max(even) <= 2 * df.count() / 8
    wide = sizes(jdbc.jdbc_parallel_scan(spark, DERBY, "BUNCHED", PROPS, "ID", 8))
    assert max(wide) > 2 * df.count() / 8  # what equal widths do


@pytest.mark.parametrize("ids", [[5], [7] * 40, [-(10**15), 10**15, 0, 1, 2, 3], [None, 1, 2, None, 3], [-9, -8, -7, -1]])
def test_every_row_is_read_once(spark, ids):
    df = table(spark, "ODD_IDS", ids)
    got = jdbc.jdbc_equi_depth_scan(spark, DERBY, "ODD_IDS", PROPS, "ID", 3)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))


def test_empty_table_and_nulls_alone(spark):
    table(spark, "NO_IDS", [])
    assert jdbc.jdbc_equi_depth_scan(spark, DERBY, "NO_IDS", PROPS, "ID", 3).count() == 0
    table(spark, "NULL_IDS", [None, None])
    assert jdbc.jdbc_equi_depth_scan(spark, DERBY, "NULL_IDS", PROPS, "ID", 3).count() == 2
