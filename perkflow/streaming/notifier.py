"""Live-activity notifier on Structured Streaming.

    change messages (Kafka topic or files)
      -> parse JSON -> keep live inserts            (stateless, in the stream)
      foreachBatch, on each micro-batch as a batch DataFrame:
      -> left join with employees                   (name or 'Employé #id')
      -> message text, or a dead-letter reason
      -> outbox partition batch_id=N + dead letters

The join runs inside foreachBatch on purpose: there adaptive execution
applies (broadcast or shuffle chosen from the batch's real size, hot
employees split by the skew-join handling), which a join inside the
streaming plan would not get. The employee side is prepared once per
refresh, hash-partitioned by employee_id and persisted, so a micro-batch
doesn't reshuffle the employee table; a new HR snapshot, or age, brings a
refresh (:class:`NameSource`), so people hired while the query runs get
their name.

The checkpoint makes a restarted query resume after the last committed batch;
a batch replayed after a failure rewrites its own outbox partition, so each
notification lands in the outbox once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.cdc import live_creations, parse_messages
from ..operators.lookup import dead_letters, name_table, notifications, with_employee_names, with_messages
from ..schemas import CDC_ACTIVITY_LSN
from ..sinks.outbox import deliver, log_only_sender, write_dead_letters, write_outbox

#: How long a redelivered change is recognised, in commit time.
REDELIVERY_DELAY = "2 days"


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "latest",
                 fail_on_data_loss: bool = False, min_partitions: int | None = None,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Change topic as a stream (needs the Kafka connector jar at runtime).
    Starts at the newest offset and tolerates lost offsets, like the original
    job. ``min_partitions`` splits large topic partitions over more tasks;
    ``max_offsets_per_trigger`` bounds a micro-batch after a backlog."""
    options = stream_options(bootstrap, topic, starting_offsets, fail_on_data_loss, min_partitions,
                             max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def stream_options(bootstrap: str, topic: str, starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                   min_partitions: int | None = None, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the topic source: newest offset first, lost offsets tolerated."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def file_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                latest_first: bool = False) -> DataFrame:
    """A folder of files as a stream (the stand-in for the topic in tests)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if latest_first:
        r = r.option("latestFirst", "true")
    return r.load(path)


def live_events(raw: DataFrame) -> DataFrame:
    """Parsed live inserts (batch or stream)."""
    return live_creations(parse_messages(raw))


def live_events_once(raw: DataFrame, delay: str = REDELIVERY_DELAY) -> DataFrame:
    """Live inserts of a stream, each source LSN once however often the topic delivers it.

    The watermark follows the changes' commit time. An LSN stays in the state
    until the watermark has passed its time by ``delay``; a redelivery within
    that time is known from the state, a later one lies behind the watermark
    and is dropped as late. So the state holds the LSNs of about ``delay`` and
    no more. First deliveries have to arrive within ``delay`` of the newest
    change; later ones are dropped too and counted (:func:`late_rows`).
    Messages without an LSN or a commit time can't be told apart: they pass as
    they come.
    """
    events = live_creations(parse_messages(raw, CDC_ACTIVITY_LSN))
    known = F.col("__source_lsn").isNotNull() & F.col("__source_ts_ms").isNotNull()
    timed = events.where(known).withColumn("committed_at", F.timestamp_millis("__source_ts_ms"))
    single = timed.withWatermark("committed_at", delay).dropDuplicatesWithinWatermark(["__source_lsn"])
    return single.drop("committed_at").unionByName(events.where(~known))


def state_sizes(query: StreamingQuery) -> list[int]:
    """Rows in the state after each recorded micro-batch."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the recorded micro-batches."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def notification_rows(events: DataFrame, employees: DataFrame) -> DataFrame:
    """Named and worded events."""
    return with_messages(with_employee_names(events, employees))


class NameSource:
    """The prepared name table of the present moment.

    ``load`` reads the employees afresh. They are read again when ``version``
    (say, the newest HR snapshot date) has changed, or else after
    ``max_age_s`` seconds; the table of before is then dropped.
    """

    def __init__(self, load: Callable[[], DataFrame], version: Callable[[], object] | None = None,
                 max_age_s: float = 60.0):
        self.load, self.version, self.max_age_s = load, version, max_age_s
        self._names: DataFrame | None = None
        self._read_at = 0.0
        self._version: object = None

    def names(self) -> DataFrame:
        version = self.version() if self.version else None
        old = time.monotonic() - self._read_at > self.max_age_s
        if self._names is None or version != self._version or (self.version is None and old):
            before = self._names
            self._names, self._version, self._read_at = prepared_names(self.load()), version, time.monotonic()
            if before is not None:
                before.unpersist()
        return self._names


def batch_writer(employees: DataFrame | NameSource, outbox_path: str, dead_letter_path: str,
                 deliveries_path: str | None = None, send=None) -> Callable[[DataFrame, int], None]:
    def process(batch: DataFrame, batch_id: int) -> None:
        names = employees.names() if isinstance(employees, NameSource) else employees
        # Persisted first: the test for an empty batch and both writes then
        # read source, parse and join once.
        rows = notification_rows(batch, names).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if rows.isEmpty():
                return
            write_outbox(notifications(rows), outbox_path, batch_id)
            write_dead_letters(dead_letters(rows), dead_letter_path, batch_id)
        finally:
            rows.unpersist()
        if deliveries_path is not None:
            # Sent right after the outbox commit; a replayed batch skips what
            # its partition of the delivery table already records as sent.
            deliver(batch.sparkSession, outbox_path, deliveries_path, send or log_only_sender, batch_id=batch_id)

    return process


def prepared_names(employees: DataFrame) -> DataFrame:
    """Name table hash-partitioned by employee_id and persisted once.

    A micro-batch cannot be the broadcast side of its own left join, so
    without this every trigger would shuffle the whole employee table. With
    it, each micro-batch shuffles only its own rows to the cached partitions.
    Lost cache blocks are recomputed from the employee table.
    """
    n = int(employees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return name_table(employees).repartition(n, "employee_id").persist(StorageLevel.MEMORY_AND_DISK)


def start_notifier(
    raw: DataFrame,
    employees: DataFrame | NameSource,
    outbox_path: str,
    dead_letter_path: str,
    checkpoint: str,
    processing_time: str | None = "2 seconds",
    available_now: bool = False,
    deliveries_path: str | None = None,
    send=None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Start the notifier. ``available_now`` drains what is there and stops.
    ``once_within`` (say, "2 days"): changes that the topic delivers again are
    not sent again (:func:`live_events_once`).
    With ``deliveries_path`` each micro-batch is also sent right away (``send``,
    default log-only) and the outcome recorded per message.
    ``employees``: a :class:`NameSource` is refreshed while the query runs; a
    DataFrame is read once into a prepared name table for the query's lifetime
    (pass the result of :func:`prepared_names` to control when it is
    unpersisted)."""
    if isinstance(employees, NameSource) or "_known_name" in employees.columns:
        names = employees
    else:
        names = prepared_names(employees)
    events = live_events(raw) if once_within is None else live_events_once(raw, once_within)
    w = events.writeStream.foreachBatch(
        batch_writer(names, outbox_path, dead_letter_path, deliveries_path, send)
    )
    w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
