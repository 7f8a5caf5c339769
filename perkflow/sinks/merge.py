"""Copy-on-write merge of a day's changes into a table cut by a hash of its key.

The table is ``bucket=K`` folders below a root; a row is the latest change of
its key, with the change's position and whether it was a delete. A merge reads
and rewrites only the buckets that the day's changes touch; files of other
buckets stay as they are, by name. Deletes stay as positions without meaning
to a reader, so that an older change that comes late can't bring a key back,
and so does the newest truncate (a row of NULL keys).

A bucket is replaced by staging and renames like any partition. A merge that
dies between two buckets leaves the rest unmerged; running it again with the
same changes completes it, since merging a change twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc
from ..sources import folders
from .lake import recover_partition, swap_in

BUCKET = "bucket"
ORDER = ("__source_lsn", "__source_ts_ms")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_changes(spark: SparkSession, changes: DataFrame, root: str, keys: Sequence[str], buckets: int,
                  order: Sequence[str] = ORDER) -> list[int]:
    """Merge ``changes`` (as ``cdc.unwrap_envelopes`` gives them) into the table at ``root``;
    returns the buckets rewritten, at most ``buckets`` numbers.

    ``buckets`` is fixed for the life of a table. Changes are reduced to one row
    per key first (with partial aggregation, so a hot key costs a row per task)
    and written, so that the merge reads the log once. No changes: nothing is
    rewritten.
    """
    root = root.rstrip("/")
    for left in folders.values_below(spark, root, f".replaced-{BUCKET}"):
        recover_partition(spark, root, BUCKET, int(left))
    staged = f"{root}/.merge"
    folders.remove(spark, staged)
    latest = cdc.latest_per_key(changes, keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
    latest.write.partitionBy(BUCKET).parquet(f"{staged}/changes")
    touched = sorted(int(b) for b in folders.values_below(spark, f"{staged}/changes", BUCKET))
    if touched:
        schema = latest.schema
        rows = _read(spark, f"{staged}/changes", schema)
        known = [b for b in touched if folders.exists(spark, f"{root}/{BUCKET}={b}")]
        if known:
            rows = rows.unionByName(read_rows(spark, root, schema).where(F.col(BUCKET).isin(known)))
        merged = cdc.latest_per_key(rows.drop(BUCKET), keys, order).withColumn(BUCKET, bucket_of(keys, buckets))
        # by bucket and key hash: a bucket is a few files, and no task holds a whole bucket of a large table
        part = F.pmod(F.hash(*keys), F.lit(FILES_PER_BUCKET))
        merged.repartition(BUCKET, part).write.partitionBy(BUCKET).parquet(f"{staged}/merged")
        for b in touched:
            swap_in(spark, f"{staged}/merged/{BUCKET}={b}", f"{root}/{BUCKET}={b}")
    folders.remove(spark, staged)
    return touched


#: Files, and so write tasks, of a rewritten bucket.
FILES_PER_BUCKET = 2


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows of the table, deletes and truncate included; ``schema`` with the bucket column."""
    return _read(spark, root, schema)


def read_merged(spark: SparkSession, root: str, keys: Sequence[str], deleted_col: str = "__deleted") -> DataFrame:
    """The current rows: no deletes, nothing at or before the newest truncate. One pass, no shuffle of rows."""
    rows = spark.read.parquet(root.rstrip("/")).drop(BUCKET)
    epoch = cdc.newest_truncate(rows, ORDER[0])
    live = cdc.keyed(rows, keys).filter(~F.col(deleted_col))
    if epoch is not None:
        live = live.filter(F.col(ORDER[0]) > F.lit(epoch))
    return live.withColumn("updated_at", cdc.millis_to_timestamp(F.col(ORDER[1])))
