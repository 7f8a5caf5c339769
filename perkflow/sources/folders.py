"""Folders of the lake through Hadoop's file system: existence, names, swap."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return bool(fs.exists(place))


def child_folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders right below ``path`` that start with ``prefix``; none if it doesn't exist."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
    return sorted(n for n in found if n.startswith(prefix))


def values_below(spark: SparkSession, path: str, part_col: str) -> list[str]:
    """Values of a partition column, from the folder names."""
    return [n.split("=", 1)[1] for n in child_folders(spark, path, f"{part_col}=")]


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, place = _at(spark, path)
    target = _at(spark, to)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(place, target):
        raise OSError(f"could not rename {path} to {to}")
