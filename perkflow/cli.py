"""Job entry points for spark-submit.

    spark-submit --py-files perkflow.zip run_job.py daily --employees PATH --activities PATH
                                          --lake ROOT --as-of 2024-01-31 [--params PATH]
                                          [--replies PATH | --provider MODULE:FUNCTION]
                                          [--cache-days N | --no-address-cache]
                                          [--jdbc-url URL --jdbc-table T --jdbc-user U --jdbc-password P]
                                          [--source-jdbc-url URL: employees/activities are table names,
                                           parameters come from --params-table]
    spark-submit run_job.py notifier --employees PATH --outbox PATH --dead-letters PATH
                                          --checkpoint PATH (--kafka HOST:PORT --topic T | --files DIR)
                                          [--available-now]
    spark-submit run_job.py state    --checkpoint PATH --updates PATH
                                          (--kafka HOST:PORT --topic T | --files DIR) [--available-now]
                                          [--dead-letters PATH]
    spark-submit run_job.py compact-state --updates PATH [--key K] [--up-to BATCH]
    spark-submit run_job.py load-hr  --file rh.csv [--sep ';' --decimal-comma] (--out PATH | --jdbc-url URL --jdbc-table T)
                                          [--rejects PATH]
    spark-submit run_job.py deliver  --outbox PATH --deliveries PATH [--webhook-url URL | MOCK]
    spark-submit run_job.py quality  (--lake ROOT --as-of 2024-01-31 | --jdbc-url URL --jdbc-table T)
                                     --expected-rows N --out PATH

Inputs are parquet folders (or any format via ``--format``). The session is
the one spark-submit configures; the checkpoint / lake paths must be on a
shared file system.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import DEFAULT_PARAMETERS
from .operators import cdc, quality
from .operators.enrichment import CallbackProvider, NoKeyProvider, StoredReplies
from .plans import medallion
from .plans.rules import gold_suite
from .schemas import CDC_ENVELOPE
from .session import SCALE_CONF
from .sinks import jdbc as jdbc_sink
from .sinks import outbox
from .sinks.keys import first_per_key
from .sources import hr_extract
from .sources import jdbc as jdbc_src
from .streaming import current_state, notifier


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _read(spark: SparkSession, path: str, fmt: str):
    return spark.read.format(fmt).load(path)


MESSAGE_FILE = T.StructType([T.StructField("value", T.StringType())])


def _change_source(spark: SparkSession, args):
    """Change messages with a ``value`` column: a Kafka topic, or files
    (text: one JSON message per line; parquet/orc: a ``value`` column)."""
    if args.kafka:
        return notifier.kafka_source(spark, args.kafka, args.topic, min_partitions=args.min_partitions,
                                     max_offsets_per_trigger=args.max_offsets_per_trigger)
    return notifier.file_source(spark, args.files, MESSAGE_FILE, fmt=args.files_format)


def _source_table(spark: SparkSession, args, name: str, key: str):
    """A source table: a path, or a database table read in parallel ranges."""
    if args.source_jdbc_url:
        return jdbc_src.jdbc_parallel_scan(spark, args.source_jdbc_url, name, _source_props(args), key,
                                           args.jdbc_partitions)
    return _read(spark, name, args.format)


def _source_props(args) -> dict[str, str]:
    props = {"user": args.source_jdbc_user or "", "password": args.source_jdbc_password or ""}
    if args.source_jdbc_driver:
        props["driver"] = args.source_jdbc_driver
    return props


def _parameters(spark: SparkSession, args):
    """The parameter history: a table by path; with a source database, the row
    in force by a subquery that the database runs; else the built-in values."""
    if args.params:
        return _read(spark, args.params, args.format)
    if args.source_jdbc_url and args.params_table:
        newest = (f"SELECT * FROM {args.params_table} WHERE snapshot_date <= DATE '{args.as_of.isoformat()}' "
                  "ORDER BY snapshot_date DESC LIMIT 1")
        return jdbc_src.jdbc_subquery_scan(spark, args.source_jdbc_url, newest, _source_props(args), "p")
    return DEFAULT_PARAMETERS


def _provider(spark: SparkSession, args):
    """Stored replies, an importable function of the caller's, or no service."""
    if args.replies:
        return StoredReplies(_read(spark, args.replies, args.format))
    if args.provider:
        module, _, name = args.provider.partition(":")
        return CallbackProvider(getattr(importlib.import_module(module), name), args.max_callers)
    return NoKeyProvider()


def cmd_daily(spark: SparkSession, args) -> dict:
    params = _parameters(spark, args)
    paths = medallion.LakePaths(args.lake, args.lake_format)
    counts = medallion.run_daily(
        spark,
        _source_table(spark, args, args.employees, "employee_id"),
        _source_table(spark, args, args.activities, "activity_id"),
        paths,
        args.as_of,
        _provider(spark, args),
        params=params,
        use_cache=not args.no_address_cache,
        cache_days=args.cache_days,
    )
    if args.jdbc_url:
        medallion.publish_gold(spark, paths, args.as_of, args.jdbc_url, args.jdbc_table, _jdbc_props(args))
    return counts


def _sender(url: str | None):
    return outbox.webhook_sender(url) if url and url != "MOCK" else outbox.log_only_sender


def cmd_notifier(spark: SparkSession, args) -> dict:
    q = notifier.start_notifier(
        _change_source(spark, args),
        notifier.NameSource(lambda: _read(spark, args.employees, args.format), max_age_s=args.names_max_age),
        args.outbox,
        args.dead_letters,
        args.checkpoint,
        available_now=args.available_now,
        deliveries_path=args.deliveries,
        send=_sender(args.webhook_url),
    )
    q.awaitTermination()
    return {"query": str(q.id)}


def cmd_state(spark: SparkSession, args) -> dict:
    changes = cdc.unwrap_envelopes(_change_source(spark, args), CDC_ENVELOPE)
    q = current_state.start_state_stream(
        changes, [args.key], args.updates, args.checkpoint, available_now=args.available_now
    )
    lost = None
    if args.dead_letters:
        lost = current_state.start_keyless_stream(
            changes, [args.key], args.dead_letters, f"{args.checkpoint.rstrip('/')}-keyless",
            available_now=args.available_now,
        )
    q.awaitTermination()
    if lost is not None:
        lost.awaitTermination()
    return {"query": str(q.id)}


def cmd_compact_state(spark: SparkSession, args) -> dict:
    return {"merged_up_to": current_state.compact_state(spark, args.updates, [args.key], args.up_to)}


def cmd_deliver(spark: SparkSession, args) -> dict:
    d = outbox.deliver(spark, args.outbox, args.deliveries, _sender(args.webhook_url), args.max_senders)
    row = d.agg(F.count_if("delivered").alias("delivered"), F.count_if(~F.col("delivered")).alias("failed")).first()
    return row.asDict()


def cmd_load_hr(spark: SparkSession, args) -> dict:
    """HR extract -> employees: insert-if-absent into a database table, or a
    parquet table. The first row of an id in the file wins. Rows that the
    employee table can't take go to ``--rejects`` with a reason; without that
    option the first such row fails the load before anything is written."""
    raw = hr_extract.read_hr_extract(spark, args.file, args.sep)
    rows, rejected = hr_extract.checked_hr_extract(raw, decimal_comma=args.decimal_comma, day_first=args.day_first)
    result = {"rejected": _write_rejects(rejected, args.rejects)}
    if args.jdbc_url:
        n = jdbc_sink.insert_ignore(spark, rows, args.jdbc_url, args.jdbc_table, _jdbc_props(args), ["employee_id"],
                                    hr_extract.POSITION, num_partitions=args.jdbc_partitions, read_by="employee_id")
        return {"inserted": n, **result}
    table = first_per_key(rows, ["employee_id"], hr_extract.POSITION).drop(hr_extract.POSITION)
    table.write.mode("overwrite").parquet(args.out)
    return {"written": spark.read.parquet(args.out).count(), **result}


def _write_rejects(rejected: DataFrame, path: str | None) -> int:
    if path is None:
        first = rejected.first()
        if first is not None:
            raise ValueError(f"HR extract row {first['line']}: {first['reason']} (give --rejects to load the others)")
        return 0
    obs = Observation("hr_rejects")
    rejected.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def _jdbc_props(args) -> dict[str, str]:
    props = {"user": args.jdbc_user or "", "password": args.jdbc_password or ""}
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    return props


def cmd_quality(spark: SparkSession, args) -> dict:
    if args.jdbc_url:  # the published serving table
        gold = jdbc_src.jdbc_parallel_scan(spark, args.jdbc_url, args.jdbc_table, _jdbc_props(args), "employee_id",
                                           args.jdbc_partitions)
    else:
        gold = medallion.read_gold(spark, medallion.LakePaths(args.lake, args.lake_format), args.as_of)
    report = quality.run_suite(gold, gold_suite(args.expected_rows))
    report.write.mode("overwrite").parquet(args.out)
    summary = quality.summarize(spark.read.parquet(args.out)).first().asDict()
    return summary


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="perkflow")
    p.add_argument("--format", default="parquet", help="format of the input tables")
    sub = p.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily", help="bronze >> silver >> gold for one day")
    for a in ("--employees", "--activities", "--lake"):
        d.add_argument(a, required=True)
    d.add_argument("--replies", help="table of stored distance replies")
    d.add_argument("--provider", help="module:function that answers a list of addresses with reply texts")
    d.add_argument("--max-callers", type=int, help="tasks calling the provider at the same time")
    d.add_argument("--cache-days", type=int, default=medallion.CACHE_DAYS, help="age after which an address is asked again")
    d.add_argument("--no-address-cache", action="store_true", help="ask for every address each day")
    d.add_argument("--params-table", default="analytics.dim_parameters", help="parameter table of the source database")
    d.add_argument("--as-of", type=_date, required=True)
    d.add_argument("--params")
    d.add_argument("--lake-format", default="parquet", help="parquet, or delta when its jar is present")
    for a in ("--jdbc-url", "--jdbc-table", "--jdbc-user", "--jdbc-password", "--jdbc-driver"):
        d.add_argument(a)
    # employees / activities given as table names of a source database
    for a in ("--source-jdbc-url", "--source-jdbc-user", "--source-jdbc-password", "--source-jdbc-driver"):
        d.add_argument(a)
    d.add_argument("--jdbc-partitions", type=int, default=16)

    for name in ("notifier", "state"):
        s = sub.add_parser(name)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--kafka")
        s.add_argument("--topic")
        s.add_argument("--files")
        s.add_argument("--files-format", default="text")
        s.add_argument("--min-partitions", type=int)
        s.add_argument("--max-offsets-per-trigger", type=int)
        s.add_argument("--available-now", action="store_true")
        if name == "notifier":
            for a in ("--employees", "--outbox", "--dead-letters"):
                s.add_argument(a, required=True)
            s.add_argument("--names-max-age", type=float, default=60.0, help="seconds after which employees are read again")
            s.add_argument("--deliveries", help="also send each micro-batch right away, outcome recorded here")
            s.add_argument("--webhook-url", help="POST target for --deliveries; empty or MOCK only logs")
        else:
            s.add_argument("--updates", required=True)
            s.add_argument("--key", default="employee_id")
            s.add_argument("--dead-letters", help="changes without a key go here")

    c = sub.add_parser("compact-state", help="merge old state updates into the base table")
    c.add_argument("--updates", required=True)
    c.add_argument("--key", default="employee_id")
    c.add_argument("--up-to", type=int, help="last batch to merge (default: the newest)")

    h = sub.add_parser("load-hr", help="HR extract (CSV, French headers) -> employees")
    h.add_argument("--file", required=True)
    h.add_argument("--sep", default=",")
    h.add_argument("--decimal-comma", action="store_true")
    h.add_argument("--day-first", action="store_true", help="dates written dd/MM/yyyy")
    h.add_argument("--out", help="parquet output (when no --jdbc-url)")
    h.add_argument("--rejects", help="table of the rows that can't be loaded, with reasons")
    h.add_argument("--jdbc-partitions", type=int, default=8)
    for a in ("--jdbc-url", "--jdbc-table", "--jdbc-user", "--jdbc-password", "--jdbc-driver"):
        h.add_argument(a)

    dl = sub.add_parser("deliver", help="send outbox notifications not delivered yet")
    dl.add_argument("--outbox", required=True)
    dl.add_argument("--deliveries", required=True)
    dl.add_argument("--webhook-url", help="POST target; empty or MOCK only logs the messages")
    dl.add_argument("--max-senders", type=int, help="tasks calling the service at the same time")

    q = sub.add_parser("quality", help="quality suite on a gold snapshot or the serving table")
    q.add_argument("--lake")
    q.add_argument("--lake-format", default="parquet")
    q.add_argument("--as-of", type=_date)
    for a in ("--jdbc-url", "--jdbc-table", "--jdbc-user", "--jdbc-password", "--jdbc-driver"):
        q.add_argument(a)
    q.add_argument("--jdbc-partitions", type=int, default=16)
    q.add_argument("--expected-rows", type=int, required=True)
    q.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"perkflow-{args.cmd}")
    for k, v in SCALE_CONF.items():  # among them the UTC session zone, whatever the cluster's is
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    commands = {"daily": cmd_daily, "notifier": cmd_notifier, "state": cmd_state, "deliver": cmd_deliver,
                "quality": cmd_quality, "load-hr": cmd_load_hr, "compact-state": cmd_compact_state}
    result = commands[args.cmd](
        spark, args
    )
    print(json.dumps(result, default=str))
    return 0 if args.cmd != "quality" or result.get("success") else 1


if __name__ == "__main__":
    sys.exit(main())
