"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

import gc
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.session import scratch_path
from perkflow.sources import folders

_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts the lineage, survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    # Shuffle files of a finished query go once the driver has dropped its handles; ask for that now.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more (all that came of them is written itself)."""
    for df in written:
        folders.remove(df.sparkSession, _WRITTEN.pop(df))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node of its component.

    Alternates the two star steps: every node hands the smallest node it knows
    to its larger, then to its smaller neighbours. The link count never
    exceeds that of the input (both directions), the number of rounds is
    logarithmic in practice, and each round is written to the shared folder.
    Ends when a round changes nothing. Links with a null end are ignored.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = e.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = materialise(e, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        old, edges = edges, materialise(small, "links")
        discard(old)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("v", "u").cast("long"))).first())
