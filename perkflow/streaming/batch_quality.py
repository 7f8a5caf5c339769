"""Quality rules of a stream, measured on each micro-batch while it is written.

The rules' counts ride on the write itself (``observe``): no second pass over
the batch, and nothing but two numbers per rule comes to the driver. A batch's
rows and its quality rows go to partitions named after the batch, so a batch
that is replayed after a failure replaces both and counts once. (A query
listener would get the same metrics after the commit, but not again after a
driver that died in between.)

Counts add up over batches, so the totals of all batches are the suite of the
whole stream. The row-count rule doesn't add up and is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import RESULT_COLUMNS, Rule

REPORT_SCHEMA = "rule string, `column` string, kind string, evaluated long, failed long, success boolean"


def write_observed(batch: DataFrame, rules: Sequence[Rule], write: Callable[[DataFrame], None]) -> list[tuple]:
    """Run ``write`` on the batch; returns one row per rule in ``RESULT_COLUMNS``, counted by that very job.

    ``write`` must read the batch to its end, once. An empty batch gives rules
    with nothing evaluated and nothing failed.
    """
    seen = Observation()
    counts = [c for i, r in enumerate(rules) for c in (r.evaluated.alias(f"e{i}"), r.failed.alias(f"f{i}"))]
    write(batch.observe(seen, *counts))
    got = seen.get
    measured = [(int(got.get(f"e{i}") or 0), int(got.get(f"f{i}") or 0)) for i in range(len(rules))]
    return [(r.name, r.column, r.kind, e, f, f == 0) for r, (e, f) in zip(rules, measured, strict=True)]


def quality_writer(rules: Sequence[Rule], rows_path: str, report_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: rows to ``rows_path/batch_id=n``, then the report to ``report_path/batch_id=n``."""
    if not rules or any(r.kind == "table_row_count" for r in rules):
        raise ValueError("rules whose counts add up over batches are needed, one at least")

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = write_observed(
            batch, rules, lambda df: df.write.mode("overwrite").parquet(f"{rows_path.rstrip('/')}/batch_id={batch_id}")
        )
        report = batch.sparkSession.createDataFrame(rows, REPORT_SCHEMA).coalesce(1)
        report.write.mode("overwrite").parquet(f"{report_path.rstrip('/')}/batch_id={batch_id}")

    return process


def start_checked_stream(rows: DataFrame, rules: Sequence[Rule], rows_path: str, report_path: str, checkpoint: str,
                         processing_time: str | None = "2 seconds", available_now: bool = False) -> StreamingQuery:
    """Write a stream's rows and a quality report per micro-batch. ``available_now`` drains what is there and stops."""
    w = rows.writeStream.foreachBatch(quality_writer(rules, rows_path, report_path)).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def batch_reports(spark: SparkSession, report_path: str) -> DataFrame:
    """``RESULT_COLUMNS`` and ``batch_id`` of every micro-batch."""
    return spark.read.schema(f"{REPORT_SCHEMA}, batch_id long").parquet(report_path)


def stream_report(reports: DataFrame) -> DataFrame:
    """The suite over all batches: what :func:`..operators.quality.run_suite` gives on all their rows."""
    total = reports.groupBy("rule", "column", "kind").agg(F.sum("evaluated").alias("evaluated"), F.sum("failed").alias("failed"))
    return total.withColumn("success", F.col("failed") == 0).select(*RESULT_COLUMNS)
