"""Benchmark decontamination with suffix arrays over the training text.

Every Spark task builds a suffix array over the words of each shard (a piece
of bounded size of its partition) and binary-searches every suffix of the
benchmark in it, one word deeper per step. A suffix whose interval is still
non-empty after a window's length gives all places where that window occurs;
neighbouring places on one diagonal join to the longest verbatim match.

The benchmark is the stated query set. It is read in blocks of at most about
``BLOCK_CHARS`` characters, each a broadcast of bounded size; a benchmark of
several blocks takes one narrow step per block over the documents, no shuffle.
Words are looked up by 64-bit hashes and compared by their bytes, so a match is
verbatim whatever the hashes do.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm.carry import packed, unpacked, with_text
from perkflow.llm.components import discard, materialise
from perkflow.llm.text import LETTER_DIGIT, Words, by_piece, expand, ngram_ranks, row_of, same_words, split_words, word_hashes, word_ranks

WINDOW = 13
BLOCK_CHARS = 16_000_000
#: Blocks searched in one stage, each by a worker of its own; what they found is then written.
CHAINED = 4
#: Text of one suffix array.
SHARD_BYTES = 2 << 20

#: Longest verbatim match of one item in one document.
MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("doc_word", T.LongType()),
        T.StructField("item_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
    ]
)


class Suffixes(NamedTuple):
    """A block of benchmark items: ids, words, word hashes, first word of each item (one more than items)."""

    ids: list[str]
    words: Words
    hashes: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list) -> Suffixes:
        w = split_words(pa.array(texts, pa.string()), LETTER_DIGIT, lower=True)
        return cls([None if i is None else str(i) for i in ids], w, word_hashes(w), w.rows)


class SuffixArray:
    """Word suffixes of one shard, in the order of their first ``depth`` words; rows end a suffix."""

    def __init__(self, words: Words, depth: int):
        self.words = words
        self.ids, self.example, self.known = word_ranks(words)
        self.stop = np.repeat(words.rows[1:], np.diff(words.rows))
        self.order = ngram_ranks(self.ids, self.stop, depth)[1]
        self.first = np.searchsorted(self.ids[self.order], np.arange(len(self.known) + 1)) if len(self.ids) else np.zeros(1, np.int64)

    def find(self, items: Suffixes) -> np.ndarray:
        """The shard's id of each benchmark word; -2 for words that the shard doesn't hold."""
        found = np.full(len(items.hashes), -2, np.int64)
        at = np.searchsorted(self.known, items.hashes)
        open_ = np.arange(len(at))
        while len(open_):  # once, but for different words of one hash
            open_ = open_[at[open_] < len(self.known)]
            open_ = open_[self.known[at[open_]] == items.hashes[open_]]
            same = same_words(items.words, open_, self.words, self.example[at[open_]])
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
        return found

    def word(self, place: np.ndarray, depth: int) -> np.ndarray:
        """Word id at ``depth`` of the suffixes at these places of the order; -1 past the row's end."""
        at = self.order[place] + depth
        ok = at < self.stop[self.order[place]]
        return np.where(ok, self.ids[np.where(ok, at, 0)], -1)

    def bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, target: np.ndarray) -> np.ndarray:
        """Binary search: first place in [lo, hi) whose word at ``depth`` is not below ``target``."""
        lo, hi = lo.copy(), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.word(mid, depth) < target[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def windows(self, items: Suffixes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of windows: (position in the shard, item, word in the item, window length)."""
        sizes = np.diff(items.rows)
        item = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(item)) - items.rows[item]
        need = np.minimum(sizes[item], length)
        q = np.flatnonzero(at + need <= sizes[item])
        found = self.find(items)
        q = q[found[q] >= 0]
        if len(q) == 0:
            return (np.zeros(0, np.int64),) * 4
        lo, hi = self.first[found[q]], self.first[found[q] + 1]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        depth = 1
        while len(q):
            full = need[q] <= depth
            done.append((q[full], lo[full], hi[full]))
            q, lo, hi = q[~full], lo[~full], hi[~full]
            target = found[q + depth]
            a, b = self.bound(lo, hi, depth, target), self.bound(lo, hi, depth, target + 1)
            live = (a < b) & (target >= 0)
            q, lo, hi = q[live], a[live], b[live]
            depth += 1
        q, lo, hi = (np.concatenate(x) for x in zip(*done, strict=True))
        place = self.order[expand(lo, hi - lo)]
        q = np.repeat(q, hi - lo)
        return place, item[q], at[q], need[q]


def covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Mask of the positions below n that lie in any [start, start + length)."""
    delta = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(delta[:n]) > 0


def runs(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row-relative [start, end) pairs of the true runs, flat, and the pair offsets of each row (in values)."""
    if len(mask) == 0:
        return np.zeros(0, np.int32), np.zeros(len(rows), np.int32)
    cut = np.zeros(len(mask) + 1, bool)
    cut[rows] = True
    start = np.flatnonzero(mask & (cut[:-1] | ~np.concatenate([[False], mask[:-1]])))
    end = np.flatnonzero(mask & (cut[1:] | ~np.concatenate([mask[1:], [False]]))) + 1
    row = np.searchsorted(rows, start, "right") - 1
    flat = np.stack([start - rows[row], end - rows[row]], 1).ravel()
    return flat.astype(np.int32), 2 * np.searchsorted(start, rows).astype(np.int32)


def longest(place: np.ndarray, item: np.ndarray, at: np.ndarray, need: np.ndarray, row: np.ndarray) -> tuple:
    """Per (row, item) the longest verbatim match: (row, item, place, item word, words)."""
    if len(place) == 0:
        return (place,) * 5
    order = np.lexsort((place, place - at, item, row))
    place, item, at, need, row = (x[order] for x in (place, item, at, need, row))
    step = np.ones(len(place), bool)
    step[1:] = (
        (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] - at[1:] != place[:-1] - at[:-1])
        | (place[1:] != place[:-1] + 1)
    )
    head = np.flatnonzero(step)
    words = np.diff(np.append(head, len(place))) - 1 + need[head]
    row, item, place, at = row[head], item[head], place[head], at[head]
    best = np.lexsort((place, -words, item, row))
    row, item, place, at, words = (x[best] for x in (row, item, place, at, words))
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    return tuple(x[keep] for x in (row, item, place, at, words))


def _scan_block(docs: DataFrame, block, window: int, text_back: bool) -> DataFrame:
    """Add one block's hits to (row, t, n_words, spans, matches); the text comes back if wanted."""
    schema = T.StructType([f for f in docs.schema.fields if text_back or f.name != "t"])
    match_type = pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())])

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        items: Suffixes = block.value
        w = split_words(piece.column("t"), LETTER_DIGIT, lower=True)
        depth = int(np.diff(items.rows).max(initial=1))
        shard = SuffixArray(w, min(depth, window))
        place, item, at, need = shard.windows(items, window)
        mask = covered(len(w.start), place, need)
        old = piece.column("spans")
        if len(old.flatten()):
            flat = old.flatten().to_numpy().reshape(-1, 2).astype(np.int64)
            base = np.repeat(w.rows[:-1], np.diff(old.offsets.to_numpy()) // 2)
            mask |= covered(len(mask), base + flat[:, 0], flat[:, 1] - flat[:, 0])
        spans, offsets = runs(mask, w.rows)
        row, item, place, at, words = longest(place, item, at, need, row_of(w)[place])
        new = pa.StructArray.from_arrays(
            [pa.array([items.ids[i] for i in item], pa.string()), pa.array(place - w.rows[row]), pa.array(at), pa.array(words)],
            fields=list(match_type),
        )
        matches = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(len(w.rows))).astype(np.int32), new)
        if len(piece.column("matches").flatten()):
            both = [a + b for a, b in zip(piece.column("matches").to_pylist(), matches.to_pylist(), strict=True)]
            matches = pa.array(both, pa.list_(match_type))
        columns = {
            "row": piece.column("row"), "t": piece.column("t"), "n_words": pa.array(np.diff(w.rows)),
            "spans": pa.ListArray.from_arrays(offsets, spans), "matches": matches,
        }
        return pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=schema.names)

    return docs.mapInArrow(by_piece("t", one, SHARD_BYTES), schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS, keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of its kept columns; default: all), ``t`` (its text, if kept),
    ``n_words``, ``spans``, ``n_hit``, ``items``, ``matches``, ``contaminated``.

    Words: runs of digits, letters a-z (A-Z in lower case) and non-ASCII
    characters. A window is ``window`` consecutive words of an item, or all of
    a shorter item. ``spans``: the hit words as flat [start, end) pairs;
    ``items``: sorted ids of the items with an occurring window (an item of
    null id hits words but is not named); ``matches``: the longest verbatim
    match of each item. ``contaminated``: hit words are at least a twentieth
    of all. Null or empty texts have no words and are clean, as is everything
    under an empty benchmark; repeated rows are judged each by itself.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("t"))
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(chars) // block_chars))
    out = docs.select(
        *packed(docs, text, keep), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"), F.array().cast(T.ArrayType(MATCH)).alias("matches"),
    )
    written = None
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b)
        rows = part.collect()  # at most about block_chars characters
        block = spark.sparkContext.broadcast(Suffixes.of([r[0] for r in rows], [r[1] for r in rows]))
        out = _scan_block(out, block, window, b < blocks - 1 or with_text(keep, text))
        if b % CHAINED == CHAINED - 1 and b < blocks - 1:
            before, out = written, materialise(out, "scanned")
            written = out
            if before is not None:
                discard(before)
    even = F.expr("aggregate(sequence(0, size(spans) - 1), 0L, (s, i) -> s + IF(i % 2 = 1, spans[i], -spans[i]))")
    out = out.withColumn("n_hit", F.when(F.size("spans") > 0, even).otherwise(F.lit(0).cast("long")))
    ids = F.filter(F.transform("matches", lambda m: m["item_id"]), lambda i: i.isNotNull())
    out = out.withColumn("items", F.array_sort(F.array_distinct(ids)))
    return out.select(
        "row", *(["t"] if with_text(keep, text) else []), "n_words", "spans", "n_hit", "items", "matches",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that ``find_contamination`` calls clean, all columns kept."""
    return unpacked(find_contamination(docs, benchmark, text, **options).where("NOT contaminated"), docs, text)
