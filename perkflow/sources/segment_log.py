"""A topic as numbered log segments: a streaming source with offsets that needs no server.

A topic is a folder with one folder per partition and, in each, immutable
Parquet segments named by the offsets they hold:

    topic/partition=0/00000000000000000000-00000000000000001000.parquet

A segment holds ``offset, value`` in offset order; offsets may have gaps, as
in a compacted topic. A segment appears under its name only when complete.
``segment_log`` is a Spark data source over such a folder; it is to the file
topic what the Kafka source is to a Kafka topic: offsets per partition in the
checkpoint, start at the earliest, the latest or given offsets, a bound on the
offsets of a micro-batch, and loss (segments that retention removed) tolerated
or fatal. A restarted query goes on from its checkpoint.

Options: ``path``; ``startingOffsets`` (``latest``, ``earliest`` or a JSON
object of partition to offset), ``maxOffsetsPerTrigger``, ``failOnDataLoss``
(default true). Files are read through ``pyarrow.fs``, one task per segment.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "partition int, offset long, value string"
_NAME = re.compile(r"(\d{20})-(\d{20})\.parquet$")
_ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])


class LostOffsets(RuntimeError):
    """Offsets that the checkpoint asks for are no longer there."""


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if urlsplit(path).scheme else (pafs.LocalFileSystem(), path)


def list_segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """(first offset, end offset, file) of every segment, ascending, per partition."""
    fs, root = _open(path)
    found: dict[int, list[tuple[int, int, str]]] = {}
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = _NAME.search(info.path)
        part = re.search(r"/partition=(\d+)/[^/]+$", info.path)
        if name and part:
            found.setdefault(int(part[1]), []).append((int(name[1]), int(name[2]), info.path))
    return {p: sorted(s) for p, s in found.items()}


class Slice(InputPartition):
    """The offsets [first, end) of one segment."""

    def __init__(self, partition: int, file: str, first: int, end: int):
        self.partition, self.file, self.first, self.end = partition, file, first, end


class SegmentLogReader(DataSourceStreamReader):
    """Plans micro-batches on the driver, reads slices on the executors."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start = options.get("startingOffsets", "latest")
        most = options.get("maxOffsetsPerTrigger")
        self.most = int(most) if most else None
        self.strict = options.get("failOnDataLoss", "true").lower() == "true"
        self.first: dict[str, int] | None = None
        self.position: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        """Where a new query begins; one answer per query, for new segments may appear meanwhile."""
        if self.first is not None:
            return self.first
        segments = list_segments(self.path)
        if self.start == "latest":
            at = {str(p): s[-1][1] for p, s in segments.items()}
        elif self.start == "earliest":
            at = {str(p): s[0][0] for p, s in segments.items()}
        else:
            at = {str(p): int(o) for p, o in json.loads(self.start).items()}
        self.first = self.position = at
        return at

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: what there is, or a bounded step from the last one's end.

        Spark plans the last batch of a restarted query first (which sets the
        position); without a position the query is new.
        """
        if self.position is None:
            self.initialOffset()
        segments = list_segments(self.path)
        ends = {str(p): s[-1][1] for p, s in segments.items()}
        behind = {p: (self._from(segments, p), end) for p, end in ends.items()}
        behind = {p: (a, b) for p, (a, b) in behind.items() if b > a}
        step = dict(self.position)
        share = None if self.most is None else -(-self.most // max(len(behind), 1))
        for p, (a, b) in behind.items():
            step[p] = b if share is None else min(b, a + share)
        return step

    def _from(self, segments: dict, p: str) -> int:
        """Where the next batch of a partition begins: its position, or later where offsets are gone."""
        at = self.position.get(p, 0)
        for first, end, _ in segments[int(p)]:
            if end > at:
                return max(at, first)
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        segments = list_segments(self.path)
        for p, stop in end.items():
            at = start.get(p)
            here = [s for s in segments.get(int(p), []) if s[0] < stop and (at is None or s[1] > at)]
            if self.strict and at is not None and stop > at:
                held = at
                for first, last, _ in here:
                    if first > held:
                        break
                    held = max(held, last)
                if held < stop:
                    raise LostOffsets(f"offsets {held} to {stop} of partition {p} are not in {self.path}")
            out += [Slice(int(p), file, max(first, at or 0), min(last, stop)) for first, last, file in here]
        self.position = {k: int(v) for k, v in end.items()}
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        try:
            source = fs.open_input_file(partition.file)
        except FileNotFoundError:
            if self.strict:
                raise LostOffsets(f"{partition.file} is gone") from None
            return
        with source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["offset", "value"]):
                offset = batch.column("offset").to_numpy()
                a, b = offset.searchsorted(partition.first), offset.searchsorted(partition.end)
                if b > a:
                    part = batch.slice(a, b - a)
                    number = pa.array([partition.partition] * part.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([number, part.column("offset"), part.column("value").cast(pa.string())], schema=_ARROW)

    def commit(self, end: dict) -> None:
        """Nothing to do: segments are kept or removed by whoever owns the topic."""


class SegmentLog(DataSource):
    """``spark.readStream.format("segment_log")``."""

    @classmethod
    def name(cls) -> str:
        return "segment_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SegmentLogReader(self.options)


def segment_source(spark: SparkSession, path: str, starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A topic of segments as a stream (``partition, offset, value``): like ``kafka_source``, it
    starts at the newest offset and tolerates lost ones unless told otherwise."""
    spark.dataSource.register(SegmentLog)
    r = spark.readStream.format("segment_log").option("path", path).option("startingOffsets", starting_offsets)
    r = r.option("failOnDataLoss", str(fail_on_data_loss).lower())
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def write_segments(messages: DataFrame, path: str, partition: Column, offset: Column, span: int) -> int:
    """Write ``value`` of ``messages`` as segments of ``span`` offsets; returns how many.

    One shuffle by (partition, segment); each segment is written by one task
    under a name of its own and then renamed, so a repeated task writes the
    same file again. ``offset`` ascends within a partition and isn't repeated.
    """
    rows = messages.select(partition.cast("int").alias("partition"), offset.cast("long").alias("offset"), F.col("value").cast("string").alias("value"))
    rows = rows.withColumn("segment", F.floor(F.col("offset") / span)).repartition("partition", "segment")
    rows = rows.sortWithinPartitions("partition", "segment", "offset")

    def publish(table: pa.Table) -> pa.RecordBatch:
        fs, root = _open(path)
        part, first, last = table.column("partition")[0].as_py(), table.column("offset")[0].as_py(), table.column("offset")[-1].as_py()
        folder = f"{root}/partition={part}"
        fs.create_dir(folder, recursive=True)
        name = f"{folder}/{first:020d}-{last + 1:020d}.parquet"
        with fs.open_output_stream(f"{name}.tmp") as out:
            pq.write_table(table.select(["offset", "value"]), out)
        fs.move(f"{name}.tmp", name)
        return pa.RecordBatch.from_pydict({"file": [name], "n": [table.num_rows]})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cut = 0
            key = list(zip(batch.column("partition").to_pylist(), batch.column("segment").to_pylist(), strict=True))
            for i, k in enumerate(key):
                before = key[i - 1] if i else (held and _key(held[-1]))
                if before and k != before:
                    if i > cut:
                        held.append(batch.slice(cut, i - cut))
                    yield publish(pa.Table.from_batches(held))
                    held, cut = [], i
            if batch.num_rows > cut:
                held.append(batch.slice(cut))
        if held:
            yield publish(pa.Table.from_batches(held))

    return rows.mapInArrow(write, "file string, n long").count()


def _key(batch: pa.RecordBatch) -> tuple[int, int]:
    last = batch.num_rows - 1
    return batch.column("partition")[last].as_py(), batch.column("segment")[last].as_py()
