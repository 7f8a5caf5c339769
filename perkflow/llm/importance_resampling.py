"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (four-byte runs, words and word
pairs, each kind in its own buckets): one of target text, the rows labelled
good, and one of raw text, all documents. A document's weight is the ratio of
its probabilities under the two; adding Gumbel noise (a hash of the id) to the
log ratio and taking the k largest samples k documents without replacement in
proportion to their weights.

The models are counts over ``BUCKETS`` buckets, summed in the tasks before the
shuffle; the raw model covers every document. The target model is fitted on at
most ``LABELLED`` labelled rows, half for the counts, half to set k: k is the
number of documents whose key is above that of all but ``1 - RECALL`` of the
held-out target rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.carry import packed, unpacked, with_text
from perkflow.llm.components import materialise
from perkflow.llm.text import NOT_SPACE, by_piece, mix, row_of, split_words, text_bytes, word_hashes

BUCKETS = 1 << 16
#: Labelled target rows used, for counts and for calibration together.
LABELLED = 20_000
#: Share of the held-out target rows that selection must reach.
RECALL = 0.9995
SEED = 17


def ngram_buckets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each n-gram, first n-gram of each row) for each kind of n-gram."""
    half = BUCKETS // 2
    shift = np.uint32(32 - (half.bit_length() - 1))
    data, off = text_bytes(column)
    quads = np.zeros(max(len(data) - 3, 0), np.uint32)
    for j in range(4):
        quads |= data[j : len(data) - 3 + j].astype(np.uint32) << np.uint32(8 * j)
    size = np.maximum(np.diff(off) - 3, 0)
    last = np.zeros(len(quads), bool)
    for j in range(1, 4):
        at = off[1:] - j
        last[at[(at >= off[:-1]) & (at < len(quads))]] = True
    quads = (quads[~last] * np.uint32(0x9E3779B1)) >> shift
    w = split_words(column, NOT_SPACE)
    h = word_hashes(w)
    row = row_of(w)
    same = row[1:] == row[:-1]
    pairs = mix(h[:-1] * np.uint64(3) + h[1:])[same]
    words = np.diff(w.rows)
    firsts = [size, words, np.maximum(words - 1, 0)]
    found = [quads.astype(np.int64), half + (h % np.uint64(half)).astype(np.int64), half + (pairs % np.uint64(half)).astype(np.int64)]
    return [(f, np.concatenate([[0], np.cumsum(n)])) for f, n in zip(found, firsts, strict=True)]


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's values; each row is added up by itself."""
    if len(values) == 0:
        return np.zeros(len(first) - 1)
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    out[full] = np.add.reduceat(values, first[full])
    return out


def _count(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) over rows (t, target)."""

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)

        def one(piece: pa.RecordBatch) -> None:
            mine = piece.column("target").to_numpy(zero_copy_only=False)
            for bucket, first in ngram_buckets(piece.column("t")):
                raw[:] += np.bincount(bucket, minlength=BUCKETS)
                target[:] += np.bincount(bucket[np.repeat(mine, np.diff(first))], minlength=BUCKETS)

        for _ in by_piece("t", one)(batches):
            pass
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])

    counts = docs.mapInArrow(run, "bucket int, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def fit_log_ratio(docs: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket, from rows (t, target); zeros if there is no target row."""
    ratio = np.zeros(BUCKETS)
    rows = _count(docs).collect()  # one row per bucket
    if rows:
        at, raw, target = np.array(rows, np.float64).T
        if target.sum():
            ratio[at.astype(np.int64)] = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return ratio


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, from counts in ever finer bins; -infinity if there are not that many."""
    lo, hi, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k > n or n == 0:
        return -math.inf
    if k < 1:
        return math.inf
    above = 0
    while lo < hi:
        width = (hi - lo) / 1024
        at = F.least(F.floor((F.col(column) - lo) / F.lit(width)), F.lit(1023)) if width > 0 else F.lit(0)
        inside = keys.where(F.col(column).between(lo, hi)).groupBy(at.alias("bin"))
        bins = inside.agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()  # at most 1024
        for b in sorted(bins, key=lambda r: -r["lo"]):
            if above + b["n"] >= k:
                break
            above += b["n"]
        if (b["lo"], b["hi"]) == (lo, hi):
            break
        lo, hi = b["lo"], b["hi"]
    return lo


class Model(NamedTuple):
    """Log ratio of each bucket, and the labelled target rows: (label_id, fit), fit false for those held out."""

    ratio: np.ndarray
    picked: DataFrame


def _marked(docs: DataFrame, picked: DataFrame, doc_id: str, columns: list) -> DataFrame:
    """``columns`` and ``fit`` (null for rows that are not picked)."""
    rows = docs.select(*columns, F.col(doc_id).cast("long").alias("id"))
    return rows.join(F.broadcast(picked), F.col("id") == F.col("label_id"), "left").drop("id", "label_id")


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", good: str = "quality",
    labelled: int = LABELLED, seed: int = SEED,
) -> Model:
    """The two models, from all of ``docs`` and at most ``labelled`` rows labelled 1.

    Labels of null ids or values are ignored. Without a label of 1 all ratios are 0.
    """
    picked = labels.where((F.col(good) == 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("label_id")).distinct()
    order = F.xxhash64("label_id", F.lit(seed + 1))
    picked = picked.orderBy(order, "label_id").limit(labelled).select("label_id", (F.pmod(order, F.lit(2)) == 0).alias("fit"))
    picked = materialise(picked, "labelled")  # at most ``labelled`` rows, so small enough to broadcast
    rows = _marked(docs, picked, doc_id, [F.col(text).alias("t")])
    return Model(fit_log_ratio(rows.select("t", F.coalesce("fit", F.lit(False)).alias("target"))), picked)


def score(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """Each row of ``docs`` as ``row`` (struct of its kept columns; default: all) and ``t`` (its text, if kept)
    with ``log_ratio``, ``key`` and ``held_out`` (a target row kept from fitting).

    Null and empty texts have log ratio 0. Rows of equal id get equal noise.
    """
    mark = F.xxhash64(F.col(doc_id).cast("long"), F.lit(seed)).alias("mark")
    rows = _marked(docs, model.picked, doc_id, [*packed(docs, text, keep), mark])
    cols = rows.select("row", "t", "mark", F.coalesce(~F.col("fit"), F.lit(False)).alias("held_out"))
    back = ["row", *(["t"] if with_text(keep, text) else [])]
    schema = cols.select(*back, "mark", "held_out", F.lit(0.0).alias("log_ratio")).schema
    ratio = docs.sparkSession.sparkContext.broadcast(model.ratio)

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        total = sum(_row_sums(ratio.value[bucket], first) for bucket, first in ngram_buckets(piece.column("t")))
        own = [piece.column(c) for c in schema.names[:-1]]
        return pa.RecordBatch.from_arrays([*own, pa.array(np.round(total, 6))], names=schema.names)

    scored = cols.mapInArrow(by_piece("t", one), schema)
    uniform = (F.pmod(F.col("mark"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return scored.select(*back, "log_ratio", (F.col("log_ratio") - F.log(-F.log(uniform))).alias("key"), "held_out")


def gumbel_top_k(scored: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """``scored`` with ``selected``: the k largest of ``keys`` (all rows that tie with the last of them)."""
    return scored.withColumn("selected", F.col("key") >= F.lit(kth_largest(keys, "key", k)))


def calibrated_k(keys: DataFrame, recall: float = RECALL) -> int:
    """Number of rows at or above the key that ``recall`` of the held-out target rows reach; all rows without any."""
    held = keys.where("held_out")
    n = held.count()
    limit = kth_largest(held, "key", math.ceil(recall * n)) if n else -math.inf
    return keys.where(F.col("key") >= F.lit(limit)).count()


def select_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int | None = None,
    keep: list[str] | None = None, **options,
) -> DataFrame:
    """The rows of ``score`` with ``log_ratio``, ``key`` and ``selected``; ``k`` None: calibrated.

    What is scored is written once. If the text is kept, the keys alone are
    written, for k and its limit, and the rows are scored again when they are
    read, which gives the same keys. An empty table gives an empty result;
    repeated rows are selected together.
    """
    model = fit(docs, labels, doc_id, text, **options)
    if with_text(keep, text):
        keys = materialise(score(docs, model, doc_id, text, keep=[]).select("key", "held_out"), "keys")
        scored = score(docs, model, doc_id, text, keep=keep)
    else:
        keys = scored = materialise(score(docs, model, doc_id, text, keep=keep), "scores")
    return gumbel_top_k(scored, keys, calibrated_k(keys) if k is None else k).drop("held_out")


def keep_selected(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that resampling selects, all columns kept."""
    return unpacked(select_quality(docs, labels, doc_id, text, **options).where("selected"), docs, text)
