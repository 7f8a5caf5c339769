"""Lake table writes: rerun-safe partition replace, row counts without a second pass."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import folders


def _value_text(value) -> str:
    return value.isoformat() if isinstance(value, dt.date) else str(value)


def replace_partition(df: DataFrame, path: str, part_col: str, value, fmt: str = "parquet") -> None:
    """Idempotent write of one partition: replaces exactly ``part_col = value``.

    Every row must belong to that partition; a foreign row fails the job.
    An empty frame leaves the partition empty. Delta uses ``replaceWhere``
    (atomic). Otherwise the rows are written to a hidden folder beside the
    partition, which no reader lists, and swapped in by two renames once the
    whole write has succeeded: a job that fails leaves the old rows, and one
    that dies between the renames is put right by the next call (or
    :func:`recover_partition`). Other partitions are untouched.
    """
    text = _value_text(value)
    checked = df.filter(
        F.when(F.col(part_col) == F.lit(value), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"row outside partition {part_col}={text}: "), F.col(part_col).cast("string")))
        )
    )
    if fmt == "delta":
        (
            checked.write.format("delta")
            .mode("overwrite")
            .option("replaceWhere", f"{part_col} = '{text}'")
            .partitionBy(part_col)
            .save(path)
        )
        return
    spark, base, name = df.sparkSession, path.rstrip("/"), f"{part_col}={text}"
    recover_partition(spark, base, part_col, value)
    staged = f"{base}/.staging-{name}-{uuid.uuid4().hex[:12]}"
    try:
        checked.drop(part_col).write.format(fmt).save(staged)
        _swap(spark, staged, f"{base}/{name}", f"{base}/.replaced-{name}")
    except BaseException:
        folders.remove(spark, staged)
        raise


def _swap(spark: SparkSession, staged: str, target: str, replaced: str) -> None:
    """Put ``staged`` in place of ``target``; if that fails, the old folder goes back."""
    old = folders.exists(spark, target)
    if old:
        folders.rename(spark, target, replaced)
    try:
        folders.rename(spark, staged, target)
    except BaseException:
        if old:
            folders.rename(spark, replaced, target)
        raise
    if old:
        folders.remove(spark, replaced)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a folder written in full beside ``target`` in its place, as :func:`replace_partition` does."""
    base, _, name = target.rstrip("/").rpartition("/")
    replaced = f"{base}/.replaced-{name}"
    if folders.exists(spark, replaced):  # an earlier swap died between its renames
        if folders.exists(spark, target):
            folders.remove(spark, replaced)
        else:
            folders.rename(spark, replaced, target)
    _swap(spark, staged, target, replaced)


def recover_partition(spark: SparkSession, path: str, part_col: str, value) -> None:
    """After a replace that died: the old rows go back if the new ones are not in place; left-overs go."""
    base, name = path.rstrip("/"), f"{part_col}={_value_text(value)}"
    target, replaced = f"{base}/{name}", f"{base}/.replaced-{name}"
    if folders.exists(spark, replaced):
        if folders.exists(spark, target):
            folders.remove(spark, replaced)
        else:
            folders.rename(spark, replaced, target)
    for left in folders.child_folders(spark, base, f".staging-{name}-"):
        folders.remove(spark, f"{base}/{left}")


def write_partitioned(df: DataFrame, path: str, part_col: str, fmt: str = "parquet",
                      files_per_value: int | None = None) -> None:
    """Initial / full write of a table partitioned by ``part_col``.

    By default every task writes one file per value it holds. With
    ``files_per_value`` the rows are first shuffled on (value, salt) where the
    salt is a hash of the whole row modulo ``files_per_value``: each value
    ends up in that many files, and a value holding a third of the rows is
    still split over ``files_per_value`` tasks. The salt is deterministic, so
    a retried task rewrites the same rows.
    """
    if files_per_value:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(F.col(part_col), salt)
    df.write.format(fmt).mode("overwrite").partitionBy(part_col).save(path)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None], name: str = "write") -> int:
    """Run ``write`` and return the number of rows it wrote, measured by an
    ``Observation`` during the same job (no second pass over the plan)."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])
