"""Tables laid out by hash buckets of a key, so that joins and counts on the key need no shuffle.

A bucketed folder holds one Parquet file per bucket, written by ``bucketBy``;
:func:`open_bucketed` declares it as an external table of the session, because
only the catalog knows that a folder is bucketed. Plain readers may read the
folder as ordinary Parquet.

A bucket is one task in every later join and nothing can split it then, so
keys that hold more than an even bucket's share of the rows stay outside the
buckets (:func:`hot_keys`). There are fewer of them than buckets, whatever the
data: their side of a join is a broadcast of a proven size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Hidden from readers of the folder.
SCHEMA_FOLDER = "_columns"


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more than 1/``buckets`` of all rows: fewer than ``buckets`` values.

    Counted with partial aggregation over all rows; only the hot keys come to the driver.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sorted(r[0] for r in counts.where(F.col(key).isNotNull() & (F.col("n") * buckets > total)).select(key).collect())


def is_hot(key: str, hot: list) -> Column:
    """Rows kept out of the buckets: hot keys, and NULL keys (which would all be one bucket). Never NULL."""
    return F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, laid_out: bool = False) -> None:
    """Write ``df`` to the new folder ``path``, one sorted file per bucket of ``key``.

    ``laid_out``: the rows come from a join of tables bucketed alike, so each
    task holds one bucket already; otherwise one shuffle lays them out.
    """
    spark, name = df.sparkSession, _table_name(path)
    rows = df if laid_out else df.repartition(buckets, key)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    # an empty table has no bucket file to take the columns from
    df.limit(0).write.mode("overwrite").parquet(f"{path}/{SCHEMA_FOLDER}")


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The rows of a bucketed folder, with their layout known to the planner."""
    name = _table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{SCHEMA_FOLDER}").schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    )
    return spark.table(name)


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"
