"""Existence guards as queries (EXISTS subqueries, stop at the first row)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def exists_flags(spark: SparkSession, **frames: DataFrame) -> DataFrame:
    """One row, one boolean column per named frame: does it have any row?"""
    return spark.range(1).select(*[df.exists().alias(name) for name, df in frames.items()])


def is_empty(df: DataFrame) -> bool:
    """Driver-side guard (one row fetched at most), e.g. to skip an empty micro-batch."""
    return df.isEmpty()
