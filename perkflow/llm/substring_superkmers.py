"""Substring dedup by super-k-mers.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the
smallest hash among its runs of ``M`` words; consecutive windows with the same
minimiser form a super-k-mer, which travels as one packed string. Equal windows
have equal minimisers, so they meet in the minimiser's bucket, where ranking
the windows exactly gives each one's smallest document.

Steps, each a Spark job written to the shared work folder:

1. index: minimiser, document, place and length of every super-k-mer, no text;
2. minimisers seen in one document only can't hold a repeat and stop here; the
   strings of the others are cut from the documents;
3. equal strings collapse before the shuffle (smallest and largest document),
   each bucket ranks its windows; a bucket of over ``BUCKET_ROWS`` different
   strings sends its windows on one by one instead, to be grouped by Spark;
4. the smallest documents go back to every occurrence; words covered by a
   window of a smaller document are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.carry import packed
from perkflow.llm.components import discard, materialise
from perkflow.llm.decontamination_suffix import covered
from perkflow.llm.text import (
    NOT_SPACE, _powers, by_piece, expand, join_words, mix, ngram_ranks, row_of, split_words, whole_groups,
    word_hashes, word_ranks,
)

WINDOW = 50
M = 10
BUCKET_ROWS = 50_000


def super_kmers(hashes: np.ndarray, rows: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, minimiser) of the super-k-mers of a piece."""
    n = len(hashes)
    if n < window:
        z = np.zeros(0, np.int64)
        return z, z, z
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    low = mix((sums[m:] - sums[:-m]) * down[: n - m + 1])
    span, width = window - m + 1, 1
    while width < span:
        step = min(width, span - width)
        low[:-step] = np.minimum(low[:-step], low[step:])
        width += step
    at = np.flatnonzero(np.repeat(rows[1:], np.diff(rows)) - np.arange(n) >= window)
    low = low[at]
    first = np.ones(len(at), bool)
    first[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(first)
    return at[head], np.diff(np.append(head, len(at))), low[head].view(np.int64)


def _index(docs: DataFrame, window: int, m: int) -> DataFrame:
    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        w = split_words(piece.column("t"), NOT_SPACE)
        start, count, low = super_kmers(word_hashes(w), w.rows, window, m)
        row = row_of(w)[start] if len(start) else start
        return pa.RecordBatch.from_arrays(
            [
                pa.array(low), piece.column("d").take(pa.array(row)), piece.column("h").take(pa.array(row)),
                pa.array((start - w.rows[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
            ],
            names=["mini", "d", "h", "start", "n"],
        )

    return docs.where("d IS NOT NULL").mapInArrow(by_piece("t", one), "mini long, d long, h long, start int, n int")


def _wanted(index: DataFrame) -> DataFrame:
    """(d, h, cuts): the super-k-mers of each document whose minimiser occurs in two documents or more."""
    shared = index.groupBy("mini").agg(F.min("d").alias("a"), F.max("d").alias("b")).where("a < b").select("mini")
    return index.join(shared, "mini").groupBy("d", "h").agg(F.collect_set(F.struct("start", "n", "mini")).alias("cuts"))


def _strings(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The strings of the wanted super-k-mers, cut from the documents."""

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        w = split_words(piece.column("t"), NOT_SPACE)
        cuts = piece.column("cuts")
        row = np.repeat(np.arange(len(cuts)), np.diff(cuts.offsets.to_numpy()))
        start, n, mini = (cuts.flatten().field(k) for k in range(3))
        a = w.rows[row] + start.to_numpy()
        size = w.end - w.start
        begin = np.cumsum(size + 1) - (size + 1)
        text = b"" if len(size) == 0 else _spaced(w)
        b = a + n.to_numpy() + window - 2
        cut = [text[i:j] for i, j in zip(begin[a].tolist(), (begin[b] + size[b]).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [mini, piece.column("d").take(pa.array(row)), piece.column("h").take(pa.array(row)), start, pa.array(cut, pa.string())],
            names=["mini", "d", "h", "start", "packed"],
        )

    strings = docs.join(wanted, ["d", "h"]).mapInArrow(by_piece("t", one), "mini long, d long, h long, start int, packed string")
    return strings.withColumn("id", F.unhex(F.md5("packed")))


def _spaced(w) -> bytes:
    """All words of a piece, each followed by one space."""
    size = w.end - w.start
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    letter = np.ones(len(out), bool)
    letter[np.cumsum(size + 1) - 1] = False
    out[letter] = w.data[NOT_SPACE[w.data]]
    return out.tobytes()


def window_minima(strings: pa.Array, low: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest ``low`` of each window's word sequence among all strings: (values, first value of each string)."""
    w = split_words(strings, NOT_SPACE)
    ids = word_ranks(w).rank
    stop = np.repeat(w.rows[1:], np.diff(w.rows))
    at = np.flatnonzero(stop - np.arange(len(ids)) >= window)
    _, rank = np.unique(ngram_ranks(ids, stop, window)[0][at], return_inverse=True)
    row = row_of(w)[at]
    best = np.full(int(rank.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(best, rank, low[row])
    return best[rank], np.searchsorted(row, np.arange(len(w.rows)))


def _over_full(strings: DataFrame, bucket_rows: int) -> DataFrame:
    """(mini, pieces) of the minimisers of over ``bucket_rows`` different strings; a piece is about an eighth of that."""
    many = strings.groupBy("mini").count().where(F.col("count") > bucket_rows).select("mini")
    ids = strings.select("mini", "id").join(F.broadcast(many), "mini", "left_semi").distinct()
    full = ids.groupBy("mini").count().where(F.col("count") > bucket_rows)
    return full.select("mini", F.ceil(8 * F.col("count") / bucket_rows).cast("int").alias("pieces"))


def _counted(strings: DataFrame, full: DataFrame, window: int, bucket_rows: int) -> DataFrame:
    """(id, lows) of each string that holds a repeat; of over-full buckets (id, place, window, low) instead."""
    distinct = strings.groupBy("mini", "id", "packed").agg(F.min("d").alias("a"), F.max("d").alias("b")).join(F.broadcast(full), "mini", "left")
    piece = F.coalesce(F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"), F.lit(0))
    distinct = distinct.withColumn("piece", piece).withColumn("pieces", F.coalesce("pieces", F.lit(0)))
    names = ["id", "lows", "place", "window", "low"]

    def whole(part: pa.Table) -> pa.RecordBatch:
        a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
        lows, offsets = window_minima(part.column("packed").combine_chunks(), a, window)
        lows_of = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(lows))
        least = np.minimum.reduceat(lows, offsets[:-1])
        keep = pa.array((a < b) | (least < a))
        n = part.num_rows
        none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
        ids = part.column("id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids, lows_of, *none], names=names).filter(keep)

    def single(part: pa.Table) -> Iterator[pa.RecordBatch]:
        for i, text, low in zip(*(part.column(k).to_pylist() for k in ("id", "packed", "a")), strict=True):
            words = text.split(" ")
            n = len(words) - window + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i] * n, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.array(range(n), pa.int32()),
                    pa.array([" ".join(words[j : j + window]) for j in range(n)], pa.string()), pa.array([low] * n, pa.int64()),
                ],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, complete in whole_groups(batches, ["mini"], 8_192, bucket_rows):
            split = part.column("pieces").to_numpy() > 0
            if not complete:
                split[:] = True
            if not split.all():
                yield whole(part.filter(pa.array(~split)))
            if split.any():
                yield from single(part.filter(pa.array(split)))

    buckets = distinct.repartition("mini", "piece").sortWithinPartitions("mini")
    return buckets.mapInArrow(run, "id binary, lows array<long>, place int, window string, low long")


def _removals(strings: DataFrame, counted: DataFrame) -> DataFrame:
    """(d, h, starts): the windows of each document that also start in a smaller one."""
    alone = counted.where("window IS NOT NULL")
    best = alone.groupBy("window").agg(F.min("low").alias("best"))
    alone = alone.join(best, "window").groupBy("id").agg(F.array_sort(F.collect_set(F.struct("place", "best"))).alias("s"))
    lows = counted.where("window IS NULL").select("id", "lows").unionByName(alone.select("id", F.col("s.best").alias("lows")))
    found = strings.select("id", "d", "h", "start").join(lows, "id").where(F.array_min("lows") < F.col("d"))
    starts = F.expr("filter(transform(lows, (v, j) -> IF(v < d, start + j, -1)), s -> s >= 0)")
    return found.select("d", "h", starts.alias("s")).groupBy("d", "h").agg(F.flatten(F.collect_set("s")).alias("starts"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, m: int = M,
    bucket_rows: int = BUCKET_ROWS, keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of its kept columns but the text; default: all), ``n_words``, ``n_removed``, ``kept``.

    Words are runs of other than ASCII white space. A word goes if a window of
    ``window`` words that covers it has the same words as a window starting in
    a document of smaller id (judged on the input). ``kept``: the other words,
    joined by one space. Null texts have no words; rows of null id keep all
    words and remove none; rows of equal id are one document for the
    comparison, and each row is answered. Texts shorter than a window stay. An
    empty table gives an empty result. Words are compared by their bytes
    inside a bucket, strings between buckets in full.
    """
    base = docs.select(*packed(docs, text, keep), F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("h"))
    rows = base.select("d", "h", "t")
    index = materialise(_index(rows, window, m), "superkmer-index")
    wanted = materialise(_wanted(index), "superkmers-wanted")
    discard(index)
    strings = materialise(_strings(rows, wanted, window), "superkmers")
    discard(wanted)
    full = materialise(_over_full(strings, bucket_rows), "over-full")
    counted = materialise(_counted(strings, full, window, bucket_rows), "windows")
    discard(full)
    removals = materialise(_removals(strings, counted), "removals")
    discard(strings, counted)
    joined = base.join(removals, ["d", "h"], "left").select("row", "t", "starts")
    schema = joined.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("t").alias("kept")).schema

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        w = split_words(piece.column("t"), NOT_SPACE)
        starts = piece.column("starts").fill_null([])
        base_word = np.repeat(w.rows[:-1], np.diff(starts.offsets.to_numpy()))
        at = base_word + starts.flatten().to_numpy()
        gone = covered(len(w.start), at, np.full(len(at), window))
        sums = np.concatenate([[0], np.cumsum(gone)])
        removed = sums[w.rows[1:]] - sums[w.rows[:-1]]
        out = [piece.column("row"), pa.array(np.diff(w.rows)), pa.array(removed), join_words(w, NOT_SPACE, ~gone)]
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    return joined.mapInArrow(by_piece("t", one), schema)
