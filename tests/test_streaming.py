"""The live notifier on Structured Streaming: stream == batch, restart from checkpoint."""

import os

import __spark_entry__ as entry
from perkflow.sources import testbed as tb
from perkflow.streaming.notifier import NameSource, file_source, kafka_source, start_notifier

from .conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark):
    q = entry.queries()
    cols = ["activity_id", "employee_id", "text"]
    assert _rows(q["cdc_stream_live"](spark, SF_SMALL), cols) == _rows(q["notification_messages"](spark, SF_SMALL), cols)


def test_restart_resumes_after_last_batch(spark, scratch):
    events = tb.table(spark, SF_SMALL, "events")
    src, out, dead, ckpt = (f"{scratch}/{n}" for n in ("in", "outbox", "dead", "ckpt"))
    events.filter("event_id < 500").write.mode("append").parquet(src)

    def run():
        stream = file_source(spark, src, events.schema)
        raw = tb.cdc_messages_from_activities(tb.activities_from_events(stream))
        q = start_notifier(raw, tb.known_employees(spark, SF_SMALL), out, dead, ckpt, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = spark.read.parquet(out)
    n1 = first.count()
    assert n1 > 0 and {r.batch_id for r in first.select("batch_id").distinct().collect()} == {0}
    run()  # same checkpoint, no new input: nothing is sent again
    assert spark.read.parquet(out).count() == n1
    events.filter("event_id >= 500").write.mode("append").parquet(src)
    run()
    allout = spark.read.parquet(out)
    assert {r.batch_id for r in allout.select("batch_id").distinct().collect()} == {0, 1}
    assert allout.filter("batch_id = 1").filter("activity_id < 500").count() == 0
    batch = entry.queries()["notification_messages"](spark, SF_SMALL)
    assert _rows(allout, ["activity_id", "text"]) == _rows(batch, ["activity_id", "text"])


def test_current_state_stream_is_incremental(spark, scratch):
    from perkflow.operators import cdc
    from perkflow.streaming.current_state import read_state, start_state_stream

    events = tb.table(spark, SF_SMALL, "events")
    src, upd, ckpt = f"{scratch}/in", f"{scratch}/updates", f"{scratch}/ckpt"

    def run():
        stream = file_source(spark, src, events.schema, max_files_per_trigger=1)
        changes = cdc.unwrap_envelopes(tb.envelopes_from_events(stream))
        q = start_state_stream(changes, ["employee_id"], upd, ckpt, available_now=True)
        q.awaitTermination(300)
        assert q.exception() is None

    events.filter("event_id < 300").write.mode("append").parquet(src)
    events.filter("event_id >= 300 AND event_id < 600").write.mode("append").parquet(src)
    run()
    batches = {r.batch_id for r in spark.read.parquet(upd).select("batch_id").distinct().collect()}
    assert len(batches) >= 2  # one input file per micro-batch
    events.filter("event_id >= 600").write.mode("append").parquet(src)
    run()  # restart: resumes from the checkpointed state store
    cols = ["employee_id", "business_unit", "gross_salary", "__source_lsn"]
    got = _rows(read_state(spark, upd, ["employee_id"]), cols)
    want = _rows(cdc.current_state(cdc.unwrap_envelopes(tb.employee_envelopes(spark, SF_SMALL)), ["employee_id"]), cols)
    assert got == want


def test_immediate_delivery_once_per_message(spark, scratch):
    events = tb.table(spark, SF_SMALL, "events")
    src, out, dead, ckpt, sent = (f"{scratch}/{n}" for n in ("in", "outbox", "dead", "ckpt", "sent"))
    events.filter("event_id < 400").write.mode("append").parquet(src)

    def run():
        stream = file_source(spark, src, events.schema)
        raw = tb.cdc_messages_from_activities(tb.activities_from_events(stream))
        q = start_notifier(raw, tb.known_employees(spark, SF_SMALL), out, dead, ckpt, available_now=True,
                           deliveries_path=sent)
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    events.filter("event_id >= 400").write.mode("append").parquet(src)
    run()
    outbox = spark.read.parquet(out)
    deliveries = spark.read.parquet(sent)
    assert deliveries.filter("delivered").count() == outbox.count()
    assert deliveries.select("activity_id", "batch_id").distinct().count() == deliveries.count()


class _StreamReader:
    """Stands in for spark.readStream: records format and options."""

    def __init__(self):
        self.fmt, self.opts = None, {}

    def format(self, fmt):
        self.fmt = fmt
        return self

    def options(self, **options):
        self.opts.update(options)
        return self

    def load(self):
        return self


def test_topic_options():
    class Session:
        readStream = _StreamReader()

    r = kafka_source(Session, "broker:9092", "activities", min_partitions=64, max_offsets_per_trigger=1000)
    assert r.fmt == "kafka"
    assert r.opts == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "activities", "startingOffsets": "latest",
        "failOnDataLoss": "false", "minPartitions": "64", "maxOffsetsPerTrigger": "1000",
    }
    Session.readStream = _StreamReader()
    assert set(kafka_source(Session, "b", "t").opts) == {"kafka.bootstrap.servers", "subscribe", "startingOffsets", "failOnDataLoss"}


def test_file_source_latest_first(spark, scratch):
    for i in range(3):
        spark.createDataFrame([(f"m{i}",)], "value string").coalesce(1).write.mode("append").text(f"{scratch}/in")
    local = scratch.removeprefix("file://").removeprefix("file:")
    files = sorted((f for f in os.listdir(f"{local}/in") if f.startswith("part-")), key=lambda f: open(f"{local}/in/{f}").read())
    for i, f in enumerate(files):
        os.utime(f"{local}/in/{f}", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    seen = []
    schema = spark.createDataFrame([], "value string").schema
    stream = file_source(spark, f"{scratch}/in", schema, fmt="text", max_files_per_trigger=1, latest_first=True)
    q = stream.writeStream.foreachBatch(lambda b, i: seen.extend(r.value for r in b.collect()))
    q = q.option("checkpointLocation", f"{scratch}/ckpt").trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    assert seen == ["m2", "m1", "m0"]


def test_new_employee_gets_a_name_while_the_query_runs(spark, scratch):
    """Hired between two batches of one running query: the second message bears the name."""
    events = tb.table(spark, SF_SMALL, "events")
    live = events.filter("event_id % 10 = 0 AND event_id % 101 != 0 AND event_id % 97 != 0 AND event_id % 89 != 0 AND event_type = 'error'")
    one = live.limit(1).collect()[0]
    src, out, emp = f"{scratch}/in", f"{scratch}/outbox", f"{scratch}/employees"
    spark.createDataFrame([(-1, "No", "One")], "employee_id long, first_name string, last_name string").write.parquet(emp)
    hired = []
    names = NameSource(lambda: spark.read.parquet(emp), version=lambda: len(hired))
    spark.createDataFrame([one], events.schema).write.mode("append").parquet(src)
    raw = tb.cdc_messages_from_activities(tb.activities_from_events(file_source(spark, src, events.schema)))
    q = start_notifier(raw, names, out, f"{scratch}/dead", f"{scratch}/ckpt", processing_time="0 seconds")
    try:
        q.processAllAvailable()
        before = spark.read.parquet(out).first().text
        rows = [(int(one.user_id), "Ana", "Lopez")]
        spark.createDataFrame(rows, "employee_id long, first_name string, last_name string").write.mode("append").parquet(emp)
        hired.append(1)
        spark.createDataFrame([one], events.schema).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert f"Employé #{one.user_id}" in before
    assert "Ana Lopez" in spark.read.parquet(f"{out}/batch_id=1").first().text


def test_names_age_out():
    class Names:
        def __init__(self):
            self.dropped = False

        def unpersist(self):
            self.dropped = True

    import perkflow.streaming.notifier as n

    made = []
    source = NameSource(lambda: None, max_age_s=0.0)
    old = n.prepared_names
    n.prepared_names = lambda _: made.append(Names()) or made[-1]
    try:
        first, second = source.names(), source.names()
        keep = NameSource(lambda: None, max_age_s=3600)
        assert keep.names() is keep.names()
    finally:
        n.prepared_names = old
    assert first is not second and first.dropped and not second.dropped


def test_keyless_changes_and_compaction(spark, scratch):
    from perkflow.operators import cdc
    from perkflow.streaming import current_state as cs

    env = tb.employee_envelopes(spark, SF_SMALL)
    upd, schema = f"{scratch}/updates", env.select("value").schema
    env.repartitionByRange(5, "key").select("value").write.parquet(f"{scratch}/in")
    changes = cdc.unwrap_envelopes(file_source(spark, f"{scratch}/in", schema, max_files_per_trigger=1))
    for q in (cs.start_state_stream(changes, ["employee_id"], upd, f"{scratch}/c1", available_now=True),
              cs.start_keyless_stream(changes, ["employee_id"], f"{scratch}/dead", f"{scratch}/c2", available_now=True)):
        q.awaitTermination()
        assert q.exception() is None
    flat = cdc.unwrap_envelopes(env)
    cols = ["employee_id", "business_unit", "gross_salary", "__source_lsn"]
    want = _rows(cdc.current_state(flat, ["employee_id"]), cols)
    assert _rows(cs.read_state(spark, upd, ["employee_id"]), cols) == want
    assert all(r[0] is not None for r in want)
    lost = ["__source_lsn", "reason"]
    assert _rows(spark.read.parquet(f"{scratch}/dead"), lost) == _rows(cdc.keyless(flat, ["employee_id"]), lost)
    assert cs.compact_state(spark, upd, ["employee_id"], upto=1) == 1
    assert cs._newer(spark, upd, None) == [2, 3, 4]
    assert _rows(cs.read_state(spark, upd, ["employee_id"]), cols) == want
    # a compaction that died before clearing: the covered folder is still there and ignored
    spark.read.parquet(f"{upd}/_base/upto=1").limit(3).write.parquet(f"{upd}/batch_id=0")
    assert _rows(cs.read_state(spark, upd, ["employee_id"]), cols) == want
    assert cs.compact_state(spark, upd, ["employee_id"]) == 4
    assert cs._newer(spark, upd, None) == [] and cs.compact_state(spark, upd, ["employee_id"]) == 4
    assert _rows(cs.read_state(spark, upd, ["employee_id"]), cols) == want
