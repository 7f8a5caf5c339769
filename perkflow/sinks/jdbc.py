"""JDBC sinks: serving-table publish (overwrite, keep DDL) and batched append."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.jdbc import jdbc_parallel_scan, jdbc_scan
from .keys import rows_to_insert


def publish(df: DataFrame, url: str, table: str, properties: Mapping[str, str], num_partitions: int = 8) -> None:
    """Replace the table content; ``truncate`` keeps the table definition
    (types, keys, grants) instead of dropping and re-creating it. At most
    ``num_partitions`` connections write at the same time; an exchange before
    the write keeps the stage that computes the rows as wide as it is."""
    (
        df.repartition(num_partitions)
        .write.mode("overwrite")
        .option("truncate", "true")
        .jdbc(url, table, properties=dict(properties))
    )


def append(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batchsize: int = 500,
           num_partitions: int = 8) -> None:
    """Append rows with JDBC batch inserts of ``batchsize`` rows per round
    trip, from at most ``num_partitions`` connections at the same time (only
    the write is that narrow, behind an exchange)."""
    (
        df.repartition(num_partitions)
        .write.mode("append")
        .option("batchsize", str(batchsize))
        .jdbc(url, table, properties=dict(properties))
    )


def insert_ignore(spark, df: DataFrame, url: str, table: str, properties: Mapping[str, str], keys: list[str],
                  order_by: str, batchsize: int = 500, num_partitions: int = 8, read_by: str | None = None) -> int:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING`` from Spark: reads only the
    key columns of the target, appends the new keys' first rows (smallest
    ``order_by``) in JDBC batches, and returns how many rows were appended.
    ``read_by``: an integer column of the target by which ``num_partitions``
    tasks read it in parallel. ``order_by`` may be a column that the target
    lacks; it is not written. Rows of a NULL key are not inserted.

    Not transactional: a concurrent writer inserting the same key between the
    read and the append makes the append fail on the table's primary key.
    """
    if read_by:
        target = jdbc_parallel_scan(spark, url, table, properties, read_by, num_partitions)
    else:
        target = jdbc_scan(spark, url, table, properties)
    written = [c for c in df.columns if c in target.columns]
    new = rows_to_insert(target.select(*keys), df, keys, order_by).select(*written)
    obs = Observation("jdbc_insert_ignore")
    append(new.observe(obs, F.count(F.lit(1)).alias("rows")), url, table, properties, batchsize, num_partitions)
    return int(obs.get["rows"])
