"""Notification outbox: one partition per micro-batch, replaced on replay."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import folders


def write_outbox(notifications: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Written by the executors into ``batch_id=<n>``. A replayed batch
    overwrites its own partition, so delivery from the outbox is once per row."""
    notifications.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")


def write_dead_letters(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    rows.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")


DELIVERY_SCHEMA = "activity_id long, batch_id long, delivered boolean, error string"


def log_only_sender(bodies):
    """Sender used when no webhook is configured: logs and reports success."""
    import logging

    log = logging.getLogger("perkflow.outbox")
    for b in bodies:
        log.info("[notification, not sent] %s", b)
    return [None] * len(bodies)


def webhook_sender(url: str, timeout_s: float = 5.0):
    """Sender that POSTs each body as JSON to ``url`` (one request per message,
    like the original job). Returns None on 2xx/3xx, else the error text."""

    def send(bodies):
        import urllib.error
        import urllib.request

        errors = []
        for b in bodies:
            req = urllib.request.Request(url, data=b.encode("utf-8"), method="POST",
                                         headers={"Content-Type": "application/json"})
            try:
                with urllib.request.urlopen(req, timeout=timeout_s) as resp:
                    errors.append(None if resp.status < 400 else f"HTTP {resp.status}")
            except urllib.error.HTTPError as ex:
                errors.append(f"HTTP {ex.code}")
            except Exception as ex:  # noqa: BLE001 - network errors are recorded, not raised
                errors.append(f"{type(ex).__name__}: {ex}")
        return errors

    return send


def deliver(spark, outbox_path: str, deliveries_path: str, send=log_only_sender, max_senders: int | None = None,
            batch_id: int | None = None):
    """Send outbox rows not delivered yet and record the outcome.

    ``send(bodies) -> errors`` is called on the executors once per Arrow batch
    (``mapInPandas``) and returns one error text (or None) per body; if the
    call itself raises, every body of the batch is retried alone. Outcomes
    are appended to ``deliveries_path`` (``activity_id, batch_id, delivered,
    error``); rows already delivered are skipped, so a rerun after a failure
    only sends what is missing. ``max_senders`` caps how many tasks call the
    service at the same time; ``batch_id`` restricts the run to one batch,
    whose folder alone is listed and read in both tables.
    """
    from pyspark.sql import functions as F

    todo = _batches(spark, outbox_path, batch_id).select("activity_id", "batch_id", "body")
    # Only a table that isn't there means "nothing delivered yet"; any other
    # trouble with it must stop the run, or every message would go out again.
    sent_before = deliveries_path if batch_id is None else f"{deliveries_path.rstrip('/')}/batch_id={batch_id}"
    if folders.exists(spark, sent_before):
        done = _batches(spark, deliveries_path, batch_id).filter(F.col("delivered"))
        todo = todo.join(done.select("activity_id", "batch_id"), ["activity_id", "batch_id"], "left_anti")

    def one(body):
        try:
            return send([body])[0]
        except Exception as ex:  # noqa: BLE001 - recorded as the row's error
            return f"{type(ex).__name__}: {ex}"

    def call(batches):
        import pandas as pd

        for pdf in batches:
            bodies = pdf["body"].tolist()
            try:
                errors = list(send(bodies)) if bodies else []
            except Exception:  # noqa: BLE001
                errors = [one(b) for b in bodies]
            yield pd.DataFrame({
                "activity_id": pdf["activity_id"],
                "batch_id": pdf["batch_id"],
                "delivered": [e is None for e in errors],
                "error": errors,
            })

    if max_senders:
        todo = todo.repartition(max_senders)
    outcome = todo.mapInPandas(call, DELIVERY_SCHEMA)
    outcome.write.mode("append").partitionBy("batch_id").parquet(deliveries_path)
    if batch_id is not None and not folders.exists(spark, sent_before):  # nothing to send in this batch
        return spark.createDataFrame([], DELIVERY_SCHEMA)
    return _batches(spark, deliveries_path, batch_id)


def _batches(spark, path: str, batch_id: int | None):
    """A table of batch folders, or one batch of it read straight from its folder."""
    if batch_id is None:
        return spark.read.parquet(path)
    base = path.rstrip("/")
    return spark.read.option("basePath", base).parquet(f"{base}/batch_id={batch_id}")
