"""Current state of a keyed change stream, kept by a streaming aggregation.

    envelopes -> unwrap -> groupBy(key).agg(max_by(row, (lsn, ts)))   [state store]
      -> outputMode("update"): only keys changed in the micro-batch
      -> foreachBatch: write them to updates/batch_id=N

The state store holds one row per key and is checkpointed, so a restart
resumes without replaying history. Readers take the latest update per key
(one partial-aggregating ``max_by``) and drop keys whose latest change is a
delete or lies before the newest truncate (kept as a row without a key). :func:`compact_state` merges the updates up to a batch into a base
table; readers then take the base and the newer folders only.

Changes without a key take no part; :func:`start_keyless_stream` keeps them
as dead letters.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.cdc import current_state, keyless, latest_change_struct, latest_per_key
from ..sources import folders

ORDER = ("__source_lsn", "__source_ts_ms")
BASE = "_base"
EVENT_TIME = "_changed_at"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_state_stream(
    changes: DataFrame,
    keys: Sequence[str],
    updates_path: str,
    checkpoint: str,
    order: Sequence[str] = ORDER,
    processing_time: str | None = "2 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    latest = latest_change_struct(changes, keys, order)
    base = updates_path.rstrip("/")

    def write_updates(batch: DataFrame, batch_id: int) -> None:
        batch.select(*keys, "_latest.*").write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")

    w = latest.writeStream.outputMode("update").foreachBatch(write_updates).option("checkpointLocation", checkpoint)
    return _start(w, available_now, processing_time)


class LatestChange(StatefulProcessor):
    """Position of a key's newest change; a delete's is forgotten ``ttl_ms`` after it, in event time."""

    def __init__(self, order: Sequence[str], ttl_ms: int):
        self.order, self.ttl_ms = tuple(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "first long, second long, forget_at long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.newest.get() if self.newest.exists() else None
        best, place = None, tuple(held[:2]) if held else (-1, -1)
        for row in rows:
            at = tuple(-1 if row[c] is None else row[c] for c in self.order)
            if at > place:
                best, place = row, at
        if best is None:
            return
        forget_at = best["__source_ts_ms"] + self.ttl_ms if best["__deleted"] and best["__source_ts_ms"] is not None else -1
        self.newest.update((*place, forget_at))
        if forget_at >= 0:
            self.handle.registerTimer(forget_at)
        yield Row(**{c: best[c] for c in best.__fields__ if c != EVENT_TIME})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.newest.get() if self.newest.exists() else None
        if held and 0 <= held[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def start_ttl_state_stream(
    changes: DataFrame,
    keys: Sequence[str],
    updates_path: str,
    checkpoint: str,
    ttl: dt.timedelta = dt.timedelta(days=7),
    delay: str = "2 days",
    order: Sequence[str] = ORDER,
    processing_time: str | None = "2 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """As :func:`start_state_stream`, with a state that forgets deleted keys.

    The state holds positions alone, no rows. A delete's position stays until
    the watermark (``delay`` behind the newest commit time) has passed its
    commit time by ``ttl``. Until then an older change of that key is known to
    be older; afterwards it lies behind the watermark and is dropped as late,
    so it can't bring the key back. Needs the RocksDB state store, which is
    set for this query alone.
    """
    spark = changes.sparkSession
    known = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    values = [c for c in changes.columns if c not in keys]
    lasting = [F.when(known, F.col(k)).alias(k) for k in keys]
    timed = changes.where(known | (F.col("__op") == "t")).select(*lasting, *values)
    timed = timed.withColumn(EVENT_TIME, F.timestamp_millis("__source_ts_ms")).withWatermark(EVENT_TIME, delay)
    processor = LatestChange(order, int(ttl / dt.timedelta(milliseconds=1)))
    schema = timed.drop(EVENT_TIME).schema
    latest = timed.groupBy(*keys).transformWithState(processor, schema, "Update", "EventTime")
    base = updates_path.rstrip("/")

    def write_updates(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")

    w = latest.writeStream.outputMode("update").foreachBatch(write_updates).option("checkpointLocation", checkpoint)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return _start(w, available_now, processing_time)
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def start_keyless_stream(
    changes: DataFrame,
    keys: Sequence[str],
    dead_letter_path: str,
    checkpoint: str,
    processing_time: str | None = "2 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append the changes without a key to ``dead_letter_path`` (its own query and checkpoint)."""
    w = keyless(changes, keys).writeStream.outputMode("append").format("parquet").option("path", dead_letter_path)
    return _start(w.option("checkpointLocation", checkpoint), available_now, processing_time)


def _start(writer, available_now: bool, processing_time: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _base_batch(spark: SparkSession, updates_path: str) -> int | None:
    """The batch up to which updates are merged into a base; None without one."""
    done = folders.values_below(spark, f"{updates_path.rstrip('/')}/{BASE}", "upto")
    return max(map(int, done)) if done else None


def _newer(spark: SparkSession, updates_path: str, than: int | None) -> list[int]:
    batches = [int(b) for b in folders.values_below(spark, updates_path, "batch_id")]
    return sorted(b for b in batches if than is None or b > than)


def _updates(spark: SparkSession, updates_path: str, upto: int | None = None) -> DataFrame:
    """The base and the update folders after it (up to a batch)."""
    path = updates_path.rstrip("/")
    merged = _base_batch(spark, path)
    batches = [b for b in _newer(spark, path, merged) if upto is None or b <= upto]
    parts = [] if merged is None else [f"{path}/{BASE}/upto={merged}"]
    parts += [f"{path}/batch_id={b}" for b in batches]
    if not parts:
        raise FileNotFoundError(f"no state updates below {updates_path}")
    return spark.read.parquet(*parts).drop("batch_id", "upto")


def read_state(spark: SparkSession, updates_path: str, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """Current rows: latest update per key, deletes removed."""
    return current_state(_updates(spark, updates_path), keys, order)


def compact_state(
    spark: SparkSession, updates_path: str, keys: Sequence[str], upto: int | None = None, order: Sequence[str] = ORDER
) -> int | None:
    """Merge the updates up to a batch (default: the newest) into the base table.

    The new base is written beside the old one and takes its name in one
    rename; only then do the folders that it covers go. Readers ignore those
    folders from the rename on, so a run that dies at any point loses nothing,
    and the next one finishes the clearing. Deletes stay in the base as rows,
    so a late reader of older folders can't bring a key back. Returns the
    batch that the base now covers.
    """
    path = updates_path.rstrip("/")
    merged = _base_batch(spark, path)
    batches = [b for b in _newer(spark, path, merged) if upto is None or b <= upto]
    if batches:
        staged = f"{path}/{BASE}/.staging-{uuid.uuid4().hex[:12]}"
        latest_per_key(_updates(spark, path, batches[-1]), keys, order).write.parquet(staged)
        folders.rename(spark, staged, f"{path}/{BASE}/upto={batches[-1]}")
        merged = batches[-1]
    if merged is not None:
        for old in folders.values_below(spark, f"{path}/{BASE}", "upto"):
            if int(old) < merged:
                folders.remove(spark, f"{path}/{BASE}/upto={old}")
        for b in folders.values_below(spark, path, "batch_id"):
            if int(b) <= merged:
                folders.remove(spark, f"{path}/batch_id={b}")
    return merged
