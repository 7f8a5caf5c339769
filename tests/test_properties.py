"""Property tests: mobility rule (P8) and rerun-safe partition replace (K1)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkflow.operators import eligibility
from perkflow.sinks.lake import replace_partition, write_partitioned
from perkflow.sources import lake

MODES = ["Marche/running", "Vélo/Trottinette/Autres", "véhicule thermique/électrique", "Transports en commun", None]


def _expected(mode, km, walk, bike):
    if km is None or mode is None:
        return False
    if mode == MODES[0]:
        return km <= walk
    if mode == MODES[1]:
        return km <= bike
    return False


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(MODES), st.one_of(st.none(), st.integers(0, 4000).map(lambda x: x / 100))),
             min_size=1, max_size=40),
    st.integers(0, 40),
    st.integers(0, 40),
)
def test_mobility_rule(spark, rows, walk, bike):
    df = spark.createDataFrame([(i, m, k) for i, (m, k) in enumerate(rows)], "i int, mode string, km double")
    limits = {MODES[0]: F.lit(walk), MODES[1]: F.lit(bike)}
    got = {r.i: r.f for r in df.select("i", eligibility.mobility_flag(F.col("mode"), F.col("km"), limits).alias("f"))
           .collect()}
    assert got == {i: _expected(m, k, walk, bike) for i, (m, k) in enumerate(rows)}


DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 10_000), st.sampled_from(DAYS)), min_size=1, max_size=30),
    st.lists(st.integers(0, 10_000), max_size=10),
    st.sampled_from(DAYS),
)
def test_replace_partition_rerun(spark, initial, replacement, day):
    from perkflow.session import scratch_path

    path = scratch_path(spark, "prop")
    write_partitioned(spark.createDataFrame(initial, "id long, extract_date date"), path, "extract_date")
    new = spark.createDataFrame([(i, day) for i in replacement], "id long, extract_date date")
    replace_partition(new, path, "extract_date", day)
    replace_partition(new, path, "extract_date", day)
    got = sorted((r.id, r.extract_date) for r in lake.read_table(spark, path).collect())
    want = sorted([(i, d) for i, d in initial if d != day] + [(i, day) for i in replacement])
    assert got == want


CHANGE = st.tuples(st.integers(0, 5), st.sampled_from(["c", "u", "d", "r"]), st.integers(0, 3),
                   st.sampled_from(["a", "b", "c"]))


@settings(max_examples=15, deadline=None)
@given(st.lists(CHANGE, min_size=1, max_size=40))
def test_current_state_matches_brute_force(spark, changes):
    from perkflow.operators import cdc

    # LSN = position in the log (unique); source time may repeat
    rows = [(k, v, op, ts, lsn, op == "d") for lsn, (k, op, ts, v) in enumerate(changes)]
    df = spark.createDataFrame(
        rows, "employee_id long, business_unit string, __op string, __source_ts_ms long, __source_lsn long, "
              "__deleted boolean")
    got = sorted((r["employee_id"], r["business_unit"], r["__source_lsn"])
                 for r in cdc.current_state(df, ["employee_id"]).collect())
    latest = {}
    for k, v, op, ts, lsn, deleted in rows:
        if k not in latest or (lsn, ts) > (latest[k][2], latest[k][3]):
            latest[k] = (k, v, lsn, ts, deleted)
    want = sorted((k, v, lsn) for k, v, lsn, ts, deleted in latest.values() if not deleted)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(
    st.sets(st.integers(0, 30), max_size=15),
    st.lists(st.tuples(st.integers(0, 30), st.integers(0, 1000)), max_size=40, unique_by=lambda t: t[1]),
)
def test_insert_ignore_matches_brute_force(spark, existing_keys, new_rows):
    from perkflow.sinks.keys import insert_ignore

    existing = spark.createDataFrame([(k, -1) for k in sorted(existing_keys)], "k long, seq long")
    new = spark.createDataFrame(new_rows, "k long, seq long")
    got = sorted(tuple(r) for r in insert_ignore(existing, new, ["k"], "seq").collect())
    first = {}
    for k, seq in new_rows:
        if k not in existing_keys and (k not in first or seq < first[k]):
            first[k] = seq
    want = sorted([(k, -1) for k in existing_keys] + list(first.items()))
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 20)), st.one_of(st.none(), st.sampled_from("abcx"))),
                max_size=40))
def test_quality_suite_matches_brute_force(spark, rows):
    from perkflow.operators import quality

    df = spark.createDataFrame(rows, "n long, u string")
    rules = [quality.expect_between("n", 0, 10), quality.expect_in_set("u", ["a", "b", "c"]),
             quality.expect_not_null("n"), quality.expect_row_count(len(rows))]
    got = {r.rule: (r.evaluated, r.failed, r.success) for r in quality.run_suite(df, rules).collect()}
    ns = [n for n, _ in rows if n is not None]
    us = [u for _, u in rows if u is not None]
    bad_n = sum(1 for n in ns if not 0 <= n <= 10)
    bad_u = sum(1 for u in us if u not in "abc")
    nulls = sum(1 for n, _ in rows if n is None)
    assert got == {
        "n_between": (len(ns), bad_n, bad_n == 0),
        "u_in_set": (len(us), bad_u, bad_u == 0),
        "n_not_null": (len(rows), nulls, nulls == 0),
        "row_count_equal": (len(rows), 0, True),
    }
