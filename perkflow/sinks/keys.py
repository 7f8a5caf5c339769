"""Insert-if-absent (``INSERT ... ON CONFLICT DO NOTHING``) as set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` (first inserted
    wins; a NULL comes first, ties go to the smallest row content, so the
    winner does not depend on partitioning). A NULL key is no key: such rows
    are left out, see :func:`without_key`. ``min`` of a struct aggregates
    partially before the shuffle (skew safe)."""
    others = [c for c in df.columns if c not in keys]
    known = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    first = F.min(F.struct(F.col(order_by).alias("_order"), F.struct(*others).alias("_r"))).alias("_first")
    return known.groupBy(*keys).agg(first).select(*keys, "_first._r.*")


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has a NULL part: no table with that primary key takes them."""
    return df.where(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)))


def rows_to_insert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """New rows whose key is not in ``existing``, one per key (none for a NULL key)."""
    return first_per_key(new, keys, order_by).join(existing.select(*keys), list(keys), "left_anti")


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Table content after the insert: existing rows unchanged plus new keys."""
    return existing.unionByName(rows_to_insert(existing, new, keys, order_by).select(*existing.columns))
