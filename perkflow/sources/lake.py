"""Reading daily snapshots of a partitioned lake table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def snapshot_scan(spark: SparkSession, path: str, as_of: dt.date, part_col: str = "extract_date",
                  fmt: str = "parquet") -> DataFrame:
    """Rows of one daily snapshot. The equality on the raw partition column
    becomes a partition filter: only that folder is listed and read."""
    return read_table(spark, path, fmt).filter(F.col(part_col) == F.lit(as_of))


def snapshot_as_of(spark: SparkSession, path: str, as_of: dt.date, part_col: str = "extract_date",
                   fmt: str = "parquet") -> DataFrame:
    """The newest snapshot dated on or before ``as_of`` ("time travel" by partition).

    For plain files the newest date comes from the partition folder names, so
    the plan lists and reads that one folder; an emptied day counts as a
    snapshot. Delta keeps its own list of files, so there the date is a scalar
    subquery over it. No snapshot that old: no rows.
    """
    t = read_table(spark, path, fmt)
    if fmt != "delta":
        days = [d for d in folders.values_below(spark, path, part_col) if d <= as_of.isoformat()]
        return t.filter(F.col(part_col) == F.lit(dt.date.fromisoformat(max(days)))) if days else t.filter(F.lit(False))
    newest = t.filter(F.col(part_col) <= F.lit(as_of)).select(F.max(part_col)).scalar()
    return t.filter(F.col(part_col) == newest)


def delta_version_as_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Delta time travel, when the Delta jar is on the classpath."""
    return spark.read.format("delta").option("versionAsOf", version).load(path)
