"""Staged JDBC writes on the embedded database: deaths, reruns, doubled attempts, readers."""

import pytest
from pyspark.sql import functions as F

from perkflow.sinks import staged_jdbc as st
from perkflow.sources.jdbc import jdbc_scan

DERBY = "jdbc:derby:memory:perkflow_staged;create=true"
PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def rows_of(spark, name):
    return sorted(map(tuple, jdbc_scan(spark, DERBY, name, PROPS).collect()))


def numbered(spark, n, start=0):
    return spark.range(start, start + n, 1, 6).select(F.col("id").alias("ID"), F.concat(F.lit("v"), "id").alias("V"))


def dying(df, at):
    """``df``, but the task that meets the id ``at`` fails."""
    bad = F.when(F.col("ID") == at, F.raise_error(F.lit("died"))).otherwise(F.col("V"))
    return df.withColumn("V", bad.cast("string"))


def tables(spark, prefix):
    sql = f"(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLENAME LIKE '{prefix}%') t"
    return {r[0] for r in spark.read.jdbc(DERBY, sql, properties=PROPS).collect()}


def after_exchange(spark, monkeypatch, at):
    """The row ``at`` kills its task in the write itself, when other tasks may have committed."""
    kind = type(spark.range(0))
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, n: dying(deal(self, n), at))


def test_rerun_after_a_death_neither_doubles_nor_loses(spark, monkeypatch):
    st.append_once(numbered(spark, 10), DERBY, "T_DEATH", PROPS, "day 1")
    before = rows_of(spark, "T_DEATH")
    with monkeypatch.context() as m:
        after_exchange(spark, m, 555)
        with pytest.raises(Exception, match="died"):
            st.append_once(numbered(spark, 1000, 100), DERBY, "T_DEATH", PROPS, "day 2", num_partitions=6)
    left = [t for t in tables(spark, "T_DEATH_STG")]
    assert len(left) == 1 and 0 < jdbc_scan(spark, DERBY, left[0], PROPS).count() < 1000  # some tasks have committed
    assert rows_of(spark, "T_DEATH") == before
    new = numbered(spark, 1000, 100)
    assert st.append_once(new, DERBY, "T_DEATH", PROPS, "day 2", num_partitions=6) == 1000
    assert rows_of(spark, "T_DEATH") == sorted(before + [tuple(r) for r in new.collect()])
    assert tables(spark, "T_DEATH") == {"T_DEATH", "T_DEATH_BATCHES"}


def test_a_closed_batch_is_not_written_again(spark):
    df = numbered(spark, 50)
    assert [st.append_once(df, DERBY, "T_ONCE", PROPS, "it's; one") for _ in range(3)] == [50, 50, 50]
    assert st.append_once(df, DERBY, "T_ONCE", PROPS, "two") == 50
    assert rows_of(spark, "T_ONCE") == sorted([tuple(r) for r in df.collect()] * 2)
    with pytest.raises(ValueError):
        st.append_once(df, DERBY, "T_ONCE", PROPS, st.PUBLISHED)


def test_attempts_that_committed_twice_count_once(spark, monkeypatch):
    once = st.write_staging

    def twice(*args):
        once(*args)
        return once(*args)  # every partition, under other attempts

    monkeypatch.setattr(st, "write_staging", twice)
    df = numbered(spark, 300)
    assert st.append_once(df, DERBY, "T_TWICE", PROPS, "b") == 300
    assert rows_of(spark, "T_TWICE") == sorted(map(tuple, df.collect()))


def test_part_of_a_task_is_refused(spark, monkeypatch):
    once = st.write_staging
    monkeypatch.setattr(st, "write_staging", lambda *a: once(*a) + 1)
    with pytest.raises(RuntimeError, match="rows of 21"):
        st.append_once(numbered(spark, 20), DERBY, "T_PART", PROPS, "b")
    assert rows_of(spark, "T_PART") == []


def test_a_run_that_was_taken_over_moves_nothing(spark, monkeypatch):
    once = st.write_staging
    later = []

    def overtaken(df, *args):
        n = once(df, *args)
        if not later:
            later.append(True)
            assert st.append_once(numbered(spark, 7), DERBY, "T_OVER", PROPS, "b") == 7
        return n

    monkeypatch.setattr(st, "write_staging", overtaken)
    with pytest.raises(RuntimeError, match="taken over"):
        st.append_once(numbered(spark, 9), DERBY, "T_OVER", PROPS, "b")
    assert len(rows_of(spark, "T_OVER")) == 7


def test_publish_replaces_whole_or_not_at_all(spark, monkeypatch):
    with st._transaction(spark, DERBY, PROPS) as db:
        st._run(db, 'CREATE TABLE T_PUB ("ID" BIGINT NOT NULL PRIMARY KEY, "V" VARCHAR(20))')
    assert st.publish_staged(numbered(spark, 30), DERBY, "T_PUB", PROPS) == 30
    old = rows_of(spark, "T_PUB")
    with pytest.raises(Exception, match="duplicate key"):  # fails after the DELETE, inside the move
        st.publish_staged(numbered(spark, 20).unionAll(numbered(spark, 1)), DERBY, "T_PUB", PROPS)
    assert rows_of(spark, "T_PUB") == old
    with monkeypatch.context() as m:
        after_exchange(spark, m, 3)
        with pytest.raises(Exception, match="died"):
            st.publish_staged(numbered(spark, 20), DERBY, "T_PUB", PROPS)
    assert rows_of(spark, "T_PUB") == old
    for n in (5, 0, 12):  # the definition stays: the key still holds
        assert st.publish_staged(numbered(spark, n), DERBY, "T_PUB", PROPS) == n
        assert rows_of(spark, "T_PUB") == sorted(map(tuple, numbered(spark, n).collect()))
    assert tables(spark, "T_PUB") == {"T_PUB", "T_PUB_BATCHES"}
    with pytest.raises(Exception, match="duplicate key"):
        st.append_once(numbered(spark, 1), DERBY, "T_PUB", PROPS, "again")


def test_nulls_types_and_names_that_clash(spark):
    df = spark.sql("SELECT 1L AS stage_part, CAST(NULL AS STRING) AS stage_attempt, 1.25BD AS money, DATE'2024-01-31' AS d "
                   "UNION ALL SELECT NULL, 'x', NULL, NULL")
    assert st.append_once(df, DERBY, "T_ODD", PROPS, "b", num_partitions=2) == 2
    got = jdbc_scan(spark, DERBY, "T_ODD", PROPS)
    assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(Exception):
        st.append_once(df.withColumn("more", F.lit(1)), DERBY, "T_ODD", PROPS, "c")
    assert jdbc_scan(spark, DERBY, "T_ODD", PROPS).count() == 2
