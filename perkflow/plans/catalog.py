"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the driver's generated tables through ``sources.testbed`` and
runs one operator of the package over all of it. The SQL oracles in
``oracles/<key>.sql`` restate the same result independently for DuckDB.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEFAULT_PARAMETERS, TEST_AS_OF
from ..functions import activity, people
from ..functions.distance import decode_replies
from ..operators import cdc, eligibility, guards, kpis, lookup, quality, refine
from ..operators.enrichment import StoredReplies, enrich_distances
from ..operators.parameters import parameter_columns, parameters_in_force
from ..schemas import CDC_ACTIVITY
from ..session import scratch_path
from ..sinks.keys import insert_ignore
from ..sinks.lake import replace_partition, write_counted, write_partitioned
from ..sinks.merge import merge_changes, read_merged
from ..sinks.outbox import write_outbox
from ..sources import lake
from ..sources import testbed as tb
from ..sources.hr_extract import HR_COLUMNS, normalize_hr_extract, read_hr_extract
from ..sources.segment_log import segment_source, write_segments
from ..streaming import batch_quality
from ..streaming.current_state import (
    compact_state, read_state, start_keyless_stream, start_state_stream, start_ttl_state_stream,
)
from ..streaming.notifier import file_source, prepared_names, start_notifier
from . import medallion, rolling
from .rules import (
    ACTIVITY_NOT_NULL, EMPLOYEE_NOT_NULL, PRIMARY_KEYS, SERVING_NOT_NULL, activity_checks, activity_stream_suite,
    employee_checks, gold_suite,
)
from .stamps import stamp

ORDERS_AS_OF = dt.date(2001, 12, 31)
SNAPSHOT_DAY = dt.date(2024, 1, 15)
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Render DATE columns as ISO text and DECIMAL columns as double.

    Engines map DATE and DECIMAL differently into pandas (date objects vs.
    timestamps, Decimal objects vs. floats), so registered results carry
    dates as ``yyyy-MM-dd`` strings and decimals as doubles; the operators
    themselves keep the real types.
    """
    conv = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            conv[f.name] = F.date_format(f.name, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            conv[f.name] = F.col(f.name).cast("double")
    return df.withColumns(conv) if conv else df


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn

    return deco


@tb.per_session
def _employees_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.employees_silver(
        tb.employees(spark, sf_dir), StoredReplies(tb.distance_replies(spark, sf_dir)), TEST_AS_OF
    )


@register("employee_eligibility")
def q_employee_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: gold eligibility table from raw employees, activities, replies, parameters."""
    return eligibility.employee_eligibility(
        _employees_silver(spark, sf_dir),
        tb.activities(spark, sf_dir),
        TEST_AS_OF,
        params=tb.parameter_history(spark),
    )


# --------------------------------------------------------------------------
# Parts of the gold computation
# --------------------------------------------------------------------------
SHORT_WINDOW_DAYS = 10
LATER_AS_OF = dt.date(2024, 7, 1)


@register("parameterized_eligibility")
def q_parameterized_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold table with the parameter row in force on 2024-07-01 (rate 8 %, ...)."""
    return eligibility.employee_eligibility(
        _employees_silver(spark, sf_dir), tb.activities(spark, sf_dir), LATER_AS_OF, params=tb.parameter_history(spark)
    )


@register("latest_parameters")
def q_latest_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter row in force on every day that has activities (O1 per daily snapshot)."""
    days = tb.activities(spark, sf_dir).select(F.to_date("start_at").alias("day"))
    return parameters_in_force(days, tb.parameter_history(spark))


@register("rolling_window_count")
def q_rolling_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities per employee over the 10 days before the as-of date."""
    return eligibility.rolling_window_count(tb.activities(spark, sf_dir), TEST_AS_OF, SHORT_WINDOW_DAYS)


ROLLING_DAYS = [dt.date(2024, 1, d) for d in range(24, 31)]


@register("rolling_window_daily")
def q_rolling_window_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10-day counts of seven days in a row, moved on from day to day; every 11th activity arrives three days late."""
    root = scratch_path(spark, "rolling")
    a = tb.activities(spark, sf_dir).withColumn("arrived_on", tb.arrival_day())
    out = []
    for day in ROLLING_DAYS:
        # the first day takes in all that has arrived so far
        came = F.col("arrived_on") <= F.lit(day) if day == ROLLING_DAYS[0] else F.col("arrived_on") == F.lit(day)
        total = rolling.advance(spark, a.where(came), root, day, SHORT_WINDOW_DAYS)
        out.append(total.withColumn("as_of", F.lit(day)))
    return reduce(DataFrame.unionByName, out)


@register("activity_counts_left")
def q_activity_counts_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every employee with the 12-month count, 0 when no activity."""
    counts = eligibility.rolling_window_count(tb.activities(spark, sf_dir), TEST_AS_OF)
    emp = tb.employee_base(spark, sf_dir).select("employee_id")
    return eligibility.with_activity_counts(emp, counts)


@register("mobility_eligibility")
def q_mobility_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parameter_columns(DEFAULT_PARAMETERS)
    e = _employees_silver(spark, sf_dir)
    flag = eligibility.mobility_flag(F.col("transport_mode"), F.col("home_to_office_km"), eligibility.mode_limits(p))
    return e.select("employee_id", "transport_mode", "home_to_office_km", flag.alias("is_eligible_premium"))


@register("wellbeing_eligibility")
def q_wellbeing_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-being flag over a 10-day window (threshold 15)."""
    counts = eligibility.rolling_window_count(tb.activities(spark, sf_dir), TEST_AS_OF, SHORT_WINDOW_DAYS)
    emp = eligibility.with_activity_counts(tb.employee_base(spark, sf_dir).select("employee_id"), counts)
    thr = DEFAULT_PARAMETERS["wellbeing_threshold"]
    return emp.select(
        "employee_id", "activities_count_12m", (F.col("activities_count_12m") >= thr).alias("is_eligible_wellbeing")
    )


@register("benefit_costs")
def q_benefit_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of the gold rules with a 10-day activity window."""
    g = eligibility.employee_eligibility(
        _employees_silver(spark, sf_dir), tb.activities(spark, sf_dir), TEST_AS_OF, days=SHORT_WINDOW_DAYS
    )
    return g.select("employee_id", "premium_amount", "wellbeing_days", "wellbeing_cost", "total_cost")


# --------------------------------------------------------------------------
# Silver layer and its scalar functions
# --------------------------------------------------------------------------
@register("employees_silver")
def q_employees_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _employees_silver(spark, sf_dir)


@register("activities_silver")
def q_activities_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.activities_silver(tb.activities(spark, sf_dir), tb.employee_base(spark, sf_dir), TEST_AS_OF)


@register("distance_enrichment")
def q_distance_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enrich_distances(tb.employee_base(spark, sf_dir), StoredReplies(tb.distance_replies(spark, sf_dir)))
    return e.select("employee_id", "home_address", "home_to_office_km", "distance_check_status")


@register("distance_reply_decode")
def q_distance_reply_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_replies(tb.home_replies(spark, sf_dir))
    return decoded.select("home_address", "home_to_office_km", "distance_check_status")


@register("full_name")
def q_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tb.employee_base(spark, sf_dir)
    return e.select("employee_id", people.full_name("first_name", "last_name").alias("full_name"))


@register("completed_years")
def q_completed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seniority of each order date as a hire date, as of 2001-12-31."""
    o = tb.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", d.alias("hire_date"), people.completed_years(ORDERS_AS_OF, d).alias("seniority_years"))


@register("activity_pace")
def q_activity_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tb.activities(spark, sf_dir)
    km = activity.metres_to_km(F.col("distance_m"))
    minutes = activity.seconds_to_minutes(F.col("duration_s"))
    return a.select(
        "activity_id",
        km.alias("distance_km"),
        minutes.alias("duration_min"),
        activity.pace_min_per_km(minutes, km).alias("pace_min_per_km"),
    )


@register("type_normalize")
def q_type_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns parsed with NULL on bad input (every 50th id, every 40th date is bad)."""
    c = tb.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    id_text = F.when(k % 50 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string"))
    day = F.date_add(F.lit(tb.BIRTH_EPOCH), ((k * 37) % 15000).cast("int")).cast("string")
    date_text = F.when(k % 40 == 0, F.lit("1990-02-30")).otherwise(day)
    raw = c.select(
        k.alias("c_custkey"),
        id_text.alias("id_text"),
        date_text.alias("date_text"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        (k % 7).cast("string").alias("days_text"),
    )
    return raw.select(
        "c_custkey",
        people.to_long_or_null(F.col("id_text")).alias("employee_id"),
        people.to_date_or_null(F.col("date_text")).alias("birth_date"),
        F.col("balance").cast("double").alias("balance"),
        people.to_int_or_null(F.col("days_text")).alias("paid_leave_days"),
    )


@register("audit_stamp")
def q_audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze stamp: extract date literal (the wall-clock extract_ts is dropped)."""
    return stamp(tb.employee_base(spark, sf_dir), TEST_AS_OF).drop("extract_ts")


@register("employees_ordered")
def q_employees_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tb.employees(spark, sf_dir)
    return e.select("employee_id", "first_name", "last_name", "hire_date").orderBy("employee_id")


@register("hr_extract_normalize")
def q_hr_extract_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees exported as a padded all-text CSV with French headers, the
    columns in reverse order and another one between them, read back and normalised."""
    path = scratch_path(spark, "hr_extract")
    e = tb.employees(spark, sf_dir)
    padded = [
        F.concat(F.lit("  "), F.col(name).cast("string"), F.lit(" ")).alias(header)
        for header, name in reversed(HR_COLUMNS.items())
    ]
    raw = e.select(*padded[:4], F.lit("x").alias("Remarque"), *padded[4:])
    raw.write.mode("overwrite").option("header", "true").csv(path)
    return normalize_hr_extract(read_hr_extract(spark, path))


# --------------------------------------------------------------------------
# Change data capture, messages, streaming
# --------------------------------------------------------------------------
@tb.per_session
def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.live_creations(cdc.parse_messages(tb.cdc_messages(spark, sf_dir)))


@register("cdc_parse_json")
def q_cdc_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.parse_messages(tb.cdc_messages(spark, sf_dir))


@register("cdc_live_filter")
def q_cdc_live_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir)


@register("cdc_unwrap")
def q_cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.unwrap_envelopes(tb.employee_envelopes(spark, sf_dir))


@register("cdc_current_state")
def q_cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = cdc.unwrap_envelopes(tb.employee_envelopes(spark, sf_dir))
    st = cdc.current_state(changes, ["employee_id"])
    return st.select(
        "employee_id", "business_unit", "transport_mode", "home_address", "gross_salary", "__source_lsn", "updated_at"
    )


@register("cdc_merged_state")
def q_cdc_merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state as a table cut by key hash, into which three shares of the change log, each out of
    order with the others, are merged one after the other."""
    root = scratch_path(spark, "merged")
    changes = cdc.unwrap_envelopes(tb.employee_envelopes(spark, sf_dir))
    for share in (1, 2, 0):
        merge_changes(spark, changes.where(F.col("__source_lsn") % 3 == share), root, ["employee_id"], BUCKETS)
    return read_merged(spark, root, ["employee_id"]).select(
        "employee_id", "business_unit", "transport_mode", "home_address", "gross_salary", "__source_lsn", "updated_at"
    )


@register("event_name_lookup")
def q_event_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lookup.with_employee_names(_live(spark, sf_dir), tb.known_employees(spark, sf_dir))
    return named.select("activity_id", "employee_id", "full_name")


@tb.per_session
def _worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.with_messages(lookup.with_employee_names(_live(spark, sf_dir), tb.known_employees(spark, sf_dir)))


@register("notification_messages")
def q_notification_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.notifications(_worded(spark, sf_dir)).select("activity_id", "employee_id", "text")


@register("dead_letter")
def q_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.dead_letters(_worded(spark, sf_dir))


@register("notification_outbox")
def q_notification_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 0 written to the outbox twice (a replay), then read back."""
    path = scratch_path(spark, "outbox")
    rows = lookup.notifications(_worded(spark, sf_dir))
    write_outbox(rows, path, 0)
    write_outbox(rows, path, 0)
    return spark.read.parquet(path).select("activity_id", "employee_id", "body")


@register("cdc_stream_live")
def q_cdc_stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live notifier as a stream over the events file, drained with availableNow."""
    base = scratch_path(spark, "notifier")
    schema = tb.table(spark, sf_dir, "events").schema
    events = file_source(spark, sf_dir, schema, glob="events.parquet")
    raw = tb.cdc_messages_from_activities(tb.activities_from_events(events))
    names = prepared_names(tb.known_employees(spark, sf_dir))
    try:
        q = start_notifier(raw, names, f"{base}/outbox", f"{base}/dead", f"{base}/_checkpoint", available_now=True)
        _await(q)
    finally:
        names.unpersist()
    return spark.read.parquet(f"{base}/outbox").select("activity_id", "employee_id", "text")


@register("cdc_current_state_stream")
def q_cdc_current_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current employee state maintained by a streaming aggregation over the
    change envelopes, one of four files per micro-batch; the first two
    batches are compacted, then base and newer updates are read."""
    base = scratch_path(spark, "state")
    _envelope_files(spark, sf_dir, f"{base}/in")
    changes = cdc.unwrap_envelopes(_envelope_stream(spark, f"{base}/in"))
    q = start_state_stream(changes, ["employee_id"], f"{base}/updates", f"{base}/_checkpoint", available_now=True)
    _await(q)
    compact_state(spark, f"{base}/updates", ["employee_id"], upto=1)
    st = read_state(spark, f"{base}/updates", ["employee_id"])
    return st.select(
        "employee_id", "business_unit", "transport_mode", "home_address", "gross_salary", "__source_lsn", "updated_at"
    )


@register("cdc_keyless_stream")
def q_cdc_keyless_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes without a key (truncates, envelopes without an image), kept by a stream as dead letters."""
    base = scratch_path(spark, "keyless")
    _envelope_files(spark, sf_dir, f"{base}/in")
    changes = cdc.unwrap_envelopes(_envelope_stream(spark, f"{base}/in"))
    _await(start_keyless_stream(changes, ["employee_id"], f"{base}/dead", f"{base}/_checkpoint", available_now=True))
    return spark.read.parquet(f"{base}/dead")


@register("cdc_state_ttl_stream")
def q_cdc_state_ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current employee state from a stream whose state holds positions alone and forgets deleted employees after three days."""
    base = scratch_path(spark, "state-ttl")
    _envelope_files(spark, sf_dir, f"{base}/in")
    changes = cdc.unwrap_envelopes(_envelope_stream(spark, f"{base}/in"))
    _await(start_ttl_state_stream(changes, ["employee_id"], f"{base}/updates", f"{base}/_checkpoint",
                                  ttl=dt.timedelta(days=3), delay="31 days", available_now=True))
    st = read_state(spark, f"{base}/updates", ["employee_id"])
    return st.select(
        "employee_id", "business_unit", "transport_mode", "home_address", "gross_salary", "__source_lsn", "updated_at"
    )


@register("topic_segment_stream")
def q_topic_segment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change messages as a topic of four partitions in numbered segments, read from
    the earliest offset in bounded micro-batches; live inserts with their place in the topic."""
    base = scratch_path(spark, "topic")
    n = tb.table(spark, sf_dir, "events").count()
    key = F.col("key")
    write_segments(tb.cdc_messages(spark, sf_dir), f"{base}/topic", key % 4, F.floor(key / 4), span=max(n // 32, 1))
    stream = segment_source(spark, f"{base}/topic", "earliest", max_offsets_per_trigger=max(n // 3, 1))
    parsed = stream.select(
        F.col("partition").alias("topic_partition"), F.col("offset").alias("topic_offset"),
        cdc.parsed_once(F.from_json("value", CDC_ACTIVITY)),
    )
    w = cdc.live_creations(parsed).writeStream.format("parquet").option("path", f"{base}/out")
    _drain(w.option("checkpointLocation", f"{base}/_checkpoint").trigger(processingTime="0 seconds").start())
    return spark.read.parquet(f"{base}/out")


@register("cdc_stream_once")
def q_cdc_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live notifier on a topic that delivers every fifth message twice and every fifteenth
    three times, the third time half the log later, behind the watermark: each is sent once."""
    base = scratch_path(spark, "once")
    n = tb.redelivered_topic(spark, sf_dir, f"{base}/topic")
    raw = segment_source(spark, f"{base}/topic", "earliest", max_offsets_per_trigger=3 * n)
    names = prepared_names(tb.known_employees(spark, sf_dir))
    try:
        _drain(start_notifier(raw, names, f"{base}/outbox", f"{base}/dead", f"{base}/_checkpoint",
                              processing_time="0 seconds", once_within="2 days"))
    finally:
        names.unpersist()
    return spark.read.parquet(f"{base}/outbox").select("activity_id", "employee_id", "text")


def _drain(q) -> None:
    """Let a running stream take in all that is there, then stop it."""
    try:
        q.processAllAvailable()
    finally:
        q.stop()


@register("cdc_stream_quality")
def q_cdc_stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules counted on every micro-batch of the change messages as it is written, one of four files
    per batch; the batches' reports added up."""
    base = scratch_path(spark, "stream-quality")
    tb.cdc_messages(spark, sf_dir).repartitionByRange(4, "key").select("value").write.parquet(f"{base}/in")
    messages = cdc.parse_messages(_envelope_stream(spark, f"{base}/in"))
    _await(batch_quality.start_checked_stream(messages, activity_stream_suite(), f"{base}/rows", f"{base}/reports",
                                              f"{base}/_checkpoint", available_now=True))
    return batch_quality.stream_report(batch_quality.batch_reports(spark, f"{base}/reports"))


def _envelope_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The change envelopes as four files, in log order."""
    tb.employee_envelopes(spark, sf_dir).repartitionByRange(4, "key").select("value").write.parquet(path)


def _envelope_stream(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("value", T.StringType())])
    return file_source(spark, path, schema, max_files_per_trigger=1)


def _await(q) -> None:
    """Wait until the stream has drained, however long that takes."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# --------------------------------------------------------------------------
# Quality, KPIs, guards
# --------------------------------------------------------------------------
@tb.per_session
def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.employee_eligibility(_employees_silver(spark, sf_dir), tb.activities(spark, sf_dir), TEST_AS_OF)


@register("quality_report")
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = tb.table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    return quality.run_suite(_gold(spark, sf_dir), gold_suite(expected))


@register("quality_summary")
def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = tb.table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    return quality.summarize(quality.run_suite(_gold(spark, sf_dir), gold_suite(expected)))


@register("constraint_violations")
def q_constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    emp = tb.employee_base(spark, sf_dir)
    act = tb.activities(spark, sf_dir)
    cust = tb.table(spark, sf_dir, "customer")
    return (
        quality.constraint_violations(emp, "employees", employee_checks())
        .unionByName(quality.constraint_violations(act, "activities", activity_checks()))
        .unionByName(quality.constraint_violations(cust, "customer", {"balance_non_negative": F.col("c_acctbal") >= 0}))
    )


@register("pk_duplicates")
def q_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once: o_custkey taken as if it were a key of
    orders, and the three tables' own keys, employees with every 17th row sent
    twice (the other two are clean)."""
    emp = tb.employee_base(spark, sf_dir)
    again = emp.unionByName(emp.filter(F.col("employee_id") % 17 == 0))
    reports = [quality.key_violations(tb.table(spark, sf_dir, "orders"), ["o_custkey"], "orders")]
    tables = {"employees": again, "activities": tb.activities(spark, sf_dir), "employee_eligibility": _gold(spark, sf_dir)}
    for name, df in tables.items():
        reports.append(quality.key_violations(df, PRIMARY_KEYS[name], name))
    return reduce(DataFrame.unionByName, reports)


@register("not_null_violations")
def q_not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL columns of the three tables: activities as parsed from the change
    messages, employees with every 19th address lost, and the eligibility table."""
    parsed = cdc.parse_messages(tb.cdc_messages(spark, sf_dir))
    lost = F.when(F.col("employee_id") % 19 != 0, F.col("home_address"))
    emp = tb.employees(spark, sf_dir).withColumn("home_address", lost)
    return (
        quality.null_counts(parsed, ACTIVITY_NOT_NULL, "activity_changes")
        .unionByName(quality.null_counts(emp, EMPLOYEE_NOT_NULL, "employees"))
        .unionByName(quality.null_counts(_gold(spark, sf_dir), SERVING_NOT_NULL, "employee_eligibility"))
    )


@register("fk_orphans")
def q_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities of unknown employees; those without an employee (every 89th here) pass, as in SQL."""
    employee = F.when(F.col("activity_id") % 89 != 0, F.col("employee_id")).alias("employee_id")
    a = tb.activities(spark, sf_dir).select("activity_id", employee)
    return quality.orphans(a, tb.known_employees(spark, sf_dir), ["employee_id"])


@register("program_kpis")
def q_program_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.program_kpis(_gold(spark, sf_dir))


@register("exists_guard")
def q_exists_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tb.activities(spark, sf_dir)
    return guards.exists_flags(
        spark,
        employees_exist=tb.employee_base(spark, sf_dir),
        historical_activities_exist=a.filter(F.col("source") == "historical"),
        future_activities_exist=a.filter(F.col("start_at") > F.lit(TEST_AS_OF)),
    )


# --------------------------------------------------------------------------
# Lake reads and writes
# --------------------------------------------------------------------------
def _bronze_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities stamped with a daily extract date (one partition per day)."""
    return tb.activities(spark, sf_dir).withColumn("extract_date", F.to_date("start_at"))


def _written_bronze(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "bronze_activities")
    write_partitioned(_bronze_activities(spark, sf_dir), path, "extract_date")
    return path


_SHARED_BRONZE: dict[str, tuple[SparkSession, str]] = {}


def _shared_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Daily bronze table written once per session for the read-only snapshot
    queries (their work is the read; the write is set-up)."""
    key = sf_dir.rstrip("/")
    if key not in _SHARED_BRONZE or _SHARED_BRONZE[key][0] is not spark:
        _SHARED_BRONZE[key] = (spark, _written_bronze(spark, sf_dir))
    return _SHARED_BRONZE[key][1]


@register("snapshot_scan")
def q_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.snapshot_scan(spark, _shared_bronze(spark, sf_dir), SNAPSHOT_DAY)


@register("snapshot_as_of")
def q_snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.snapshot_as_of(spark, _shared_bronze(spark, sf_dir), TEST_AS_OF)


@register("replace_partition")
def q_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table written, then one day replaced twice (rerun): no row lost or doubled."""
    path = _written_bronze(spark, sf_dir)
    day = _bronze_activities(spark, sf_dir).filter(F.col("extract_date") == F.lit(SNAPSHOT_DAY))
    replace_partition(day, path, "extract_date", SNAPSHOT_DAY)
    replace_partition(day, path, "extract_date", SNAPSHOT_DAY)
    return spark.read.parquet(path)


@register("write_row_count")
def q_write_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written to silver activities, observed during the write itself."""
    path = scratch_path(spark, "silver_activities")
    df = refine.activities_silver(tb.activities(spark, sf_dir), tb.employee_base(spark, sf_dir), TEST_AS_OF)
    n = write_counted(df, lambda d: write_partitioned(d, path, "extract_date"), "silver_activities")
    return spark.read.parquet(path).groupBy().agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit("silver_activities").alias("table_name"), F.lit(n).cast("bigint").alias("rows_written"), "rows_read"
    )


@register("insert_ignore")
def q_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing = even customers; new = one row per order, first order per key wins."""
    existing = tb.employee_base(spark, sf_dir).filter(F.col("employee_id") % 2 == 0).select(
        "employee_id", F.lit(None).cast("bigint").alias("first_order"), F.lit("existing").alias("origin")
    )
    o = tb.table(spark, sf_dir, "orders")
    new = o.select(
        F.col("o_custkey").alias("employee_id"), F.col("o_orderkey").alias("first_order"), F.lit("inserted").alias("origin")
    )
    return insert_ignore(existing, new, ["employee_id"], "first_order")


# --------------------------------------------------------------------------
# End to end: bronze >> silver >> gold through written tables
# --------------------------------------------------------------------------
@register("daily_gold_run")
def q_daily_gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily run into a fresh lake folder, then the gold partition
    read back (reruns of a day are covered by tests/test_medallion.py)."""
    paths = medallion.LakePaths(scratch_path(spark, "lake"))
    provider = StoredReplies(tb.distance_replies(spark, sf_dir))
    medallion.run_daily(
        spark, tb.employees(spark, sf_dir), tb.activities(spark, sf_dir), paths, TEST_AS_OF, provider,
        params=tb.parameter_history(spark),
    )
    return medallion.read_gold(spark, paths, TEST_AS_OF).select(*eligibility.GOLD_COLUMNS)


@register("daily_gold_bucketed")
def q_daily_gold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run with employees and activities bucketed by employee, so that no join shuffles."""
    paths = medallion.LakePaths(scratch_path(spark, "lake"))
    provider = StoredReplies(tb.distance_replies(spark, sf_dir))
    medallion.run_daily(
        spark, tb.employees(spark, sf_dir), tb.activities(spark, sf_dir), paths, TEST_AS_OF, provider,
        params=tb.parameter_history(spark), buckets=BUCKETS,
    )
    return medallion.read_gold(spark, paths, TEST_AS_OF).select(*eligibility.GOLD_COLUMNS)
