"""Mixing sources to target weights: DataFrame expressions only.

Words are summed per source, targets follow from the weights, and a document
is emitted floor(rate) times plus once more with the probability of the rate's
fraction, by a hash of its id and the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkflow.llm.components import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"


def word_count(text: str) -> Column:
    """Number of runs of other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources by code point, null last, weigh ``weights``, repeating, and share
    the total size. A target stops at ``most`` times its source's size and the
    excess is shared again by weight. The sources that stop are the first by
    size over weight, so one pass in that order finds them all: the ordered
    windows hold one row per source, after the sums.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", weight)
    order = Window.orderBy(F.col("source_size") / F.col("w"), "rank")
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("source_size") * most
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(stop).over(before), F.lit(0))
    weights_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    level = ranked.withColumns({"stop": stop, "level": left.cast("double") / weights_left})
    stopped = F.col("w") * F.col("level") > F.col("stop")
    level = level.withColumn("final", F.min_by(F.when(~stopped, F.col("level")), F.when(~stopped, F.struct(F.col("source_size") / F.col("w"), "rank"))).over(every))
    target = F.when(stopped, F.col("stop").cast("double")).otherwise(F.col("w") * F.col("final"))
    return level.select("source", "source_size", target.alias("target"))


def uniform(doc_id: str, seed: str) -> Column:
    """A number in [0, 1) from a hash of the id (null: of the word null) and the seed."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def plan_mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """Each row of ``docs`` as ``row`` with ``size``, ``source_size``, ``target``, ``copies``.

    Null texts and texts without words have size 0; null sources are one
    source, last in order; a source without words has target 0 and no copies;
    rows of equal id draw alike. An empty table gives an empty result. The
    table of sources is written and reread, so Spark knows its size when it
    chooses between broadcast and shuffle for the join.
    """
    sized = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"))
    targets = materialise(source_targets(sized.select("source", "size"), weights, most), "sources").withColumnRenamed("source", "of")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["of"]))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    copies = F.floor("rate") + F.when(uniform("id", seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    joined = joined.withColumn("rate", rate)
    return joined.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as planned, all columns kept."""
    planned = plan_mix(docs, **options).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
