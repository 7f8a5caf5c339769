"""Hard-negative mining by a BOND scan: vectors stored by dimension, read until bounds decide.

All vectors are written once as fragments: up to ``FRAGMENT_ROWS`` vectors, one
binary column per dimension with its smallest and largest value, rows in label
order. An anchor reads a fragment's dimensions in descending order of its own
magnitudes. After each step the part of the product that is still missing lies
between the sums of the remaining dimensions' smallest and largest
contributions, so every candidate has a lower and an upper bound of its score.
Candidates whose bounds miss every score wanted leave the bitmap; those that
stay to the last dimension have exact scores.

Two scans per block of anchors: first the best rows of the anchor's own label
(positives), then the best rows of other labels within each positive's score
window (negatives). The scores to beat start from a part of the anchors' own
block, which is data too, and rise as the scan finds better rows.

Spark's work: anchors are dealt into blocks of about ``BLOCK_ANCHORS``; per
block a narrow pass over the fragments with the block broadcast, then the top
few per anchor by a ranked window with a limit ahead of its shuffle. A block,
its positives and its few best rows per anchor are all that the driver or a
task holds besides one fragment. Blocks' results are written one by one. That
each anchor meets every row is the query's own size (anchors x rows); no pair
is emitted but the best.

Defined cases. Rows with a null label, a null vector or a null or non-finite
component take no part. Shorter vectors end in zeros; scaled components are
held within +-2**24. A null id is no anchor and comes last among ties, and so
would the largest long. Rows with one id are rows of their own, each an anchor
or a partner; a row is never its own positive. An empty table, no anchors, or
no rows of another label give no rows. There is no text; only the three named
columns are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perkflow.llm.components import discard, materialise
from perkflow.llm.vectors import binary, longest, number_type, rows_of, scaled, usable

#: Vectors in one fragment.
FRAGMENT_ROWS = 4096
#: Anchors searched for in one pass over the fragments.
BLOCK_ANCHORS = 16_384
#: Anchors of the block whose scores give the first scores to beat.
SEED_ROWS = 2048
#: Dimensions read between two looks at the bounds.
STEP = 8
NO_ID = 2**63 - 1
LOWEST = -(2**62)


class Block(NamedTuple):
    """Anchors of one pass: where each stands, its label, its vector and the order of its dimensions."""

    fragment: np.ndarray
    place: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    order: np.ndarray


class Best:
    """The best ``k`` (score, id) seen per slot, ties to the smaller id, and the score that a newcomer has to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.score, self.ids = [np.zeros(0, np.int64)] * len(floor), [np.zeros(0, np.int64)] * len(floor)

    def add(self, slot: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[slot], score]), np.concatenate([self.ids[slot], ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score[slot], self.ids[slot] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[slot] = max(self.floor[slot], self.score[slot][-1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, id, score) of all that is held."""
        slot = np.repeat(np.arange(len(self.score)), [len(s) for s in self.score])
        return slot, np.concatenate([*self.ids, np.zeros(0, np.int64)]), np.concatenate([*self.score, np.zeros(0, np.int64)])


def fragments(rows: DataFrame, width: int, scale: int, most: int) -> DataFrame:
    """(fragment, ids, labels, low, high, dims): the vectors by dimension, ``most`` to a fragment, in label order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                label = np.asarray(part.column("label"))
                order = np.argsort(label, kind="stable")
                v = scaled(part.column("t"), scale, width)[order].astype(np.int32)
                ids = np.asarray(part.column("id").fill_null(NO_ID))[order]
                yield pa.RecordBatch.from_pydict(
                    {
                        "fragment": pa.array([at], pa.int64()), "ids": binary(ids[None]), "labels": binary(label[order][None]),
                        "low": binary(v.min(0)[None]), "high": binary(v.max(0)[None]),
                        "dims": pa.array([[d.tobytes() for d in v.T]], pa.list_(pa.binary())),
                    }
                )
                at += 1

    schema = "fragment long, ids binary, labels binary, low binary, high binary, dims array<binary>"
    return rows.mapInArrow(cut, schema)


class Fragment(NamedTuple):
    """One fragment in a task; ``dims``: dimension x row."""

    at: int
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    dims: np.ndarray


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Fragment]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            ids = np.frombuffer(row["ids"].as_py(), np.int64)
            dims = [np.frombuffer(d.as_buffer(), np.int32) for d in row["dims"]] if "dims" in row else []
            dims = np.array(dims, np.int32).reshape(width, len(ids))
            yield Fragment(
                row["fragment"].as_py(), ids, np.frombuffer(row["labels"].as_py(), np.int64),
                np.frombuffer(row["low"].as_py(), np.int32), np.frombuffer(row["high"].as_py(), np.int32), dims,
            )


def _anchors(table: DataFrame, width: int, every: int, blocks: int) -> DataFrame:
    """(block, fragment, place, id, label, v) of the rows whose id ``every`` divides."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in _read(batches, width):
            at = np.flatnonzero((f.ids % every == 0) & (f.ids != NO_ID))
            if len(at):
                yield pa.RecordBatch.from_pydict(
                    {
                        "fragment": pa.array(np.full(len(at), f.at)), "place": pa.array(at.astype(np.int64)), "id": pa.array(f.ids[at]),
                        "label": pa.array(f.labels[at]), "v": binary(f.dims[:, at].T),
                    }
                )

    found = table.mapInArrow(pick, "fragment long, place long, id long, label long, v binary")
    return found.withColumn("block", F.pmod(F.xxhash64("fragment", "place"), F.lit(blocks)))


def _block(rows: DataFrame, width: int) -> Block:
    """The anchors of one block, on the driver (about BLOCK_ANCHORS rows)."""
    t = rows.orderBy("fragment", "place").toArrow().combine_chunks()
    number = lambda c: t.column(c).to_numpy().astype(np.int64)
    column = t.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    v = rows_of(column.cast(pa.binary()), np.int32, width).astype(np.int64)
    order = np.argsort(-np.abs(v), axis=1, kind="stable")
    return Block(number("fragment"), number("place"), number("id"), number("label"), v, order)


def _remaining(block: Block, f: Fragment) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest sum over the dimensions after the first k of each anchor's order, for every k."""
    a, b = block.vector * f.low, block.vector * f.high
    out = []
    for each in (np.minimum(a, b), np.maximum(a, b)):
        each = np.take_along_axis(each, block.order, 1)[:, ::-1].cumsum(1)[:, ::-1]
        out.append(np.concatenate([each, np.zeros((len(each), 1), np.int64)], 1))
    return out[0], out[1]


def _scan(dims: np.ndarray, rows: np.ndarray, q: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: Callable) -> tuple:
    """(rows, exact scores) of the candidates that ``wanted`` lets through to the last dimension.

    ``wanted(lower, upper)`` is the bitmap of candidates whose score may be asked for.
    """
    score = np.zeros(len(rows), dims.dtype)
    for k in range(0, len(order), STEP):
        read = order[k : k + STEP]
        score += q[read] @ dims[read[:, None], rows]
        done = min(k + STEP, len(order))
        stays = wanted(score + low[done], score + high[done])
        if not stays.all():
            rows, score = rows[stays], score[stays]
            if not len(rows):
                break
    return rows, score.astype(np.int64)


def _typed(block: Block, f: Fragment) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and anchors as numbers in which all sums are exact."""
    peak = int(max(np.abs(f.low.astype(np.int64)).max(initial=0), np.abs(f.high.astype(np.int64)).max(initial=0), np.abs(block.vector).max(initial=0)))
    number = number_type(peak, f.dims.shape[0])
    return f.dims.astype(number), block.vector.astype(number)


def _positives(block, floor: np.ndarray, k: int) -> Callable:
    """A mapInArrow function: the task's best rows of each anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        best = Best(floor, k)
        for f in _read(batches, b.vector.shape[1]):
            dims, vector = _typed(b, f)
            low, high = _remaining(b, f)
            first, last = np.searchsorted(f.labels, b.label), np.searchsorted(f.labels, b.label, "right")
            for i in np.flatnonzero((last > first) & (high[:, 0] >= best.floor)):
                rows = np.arange(first[i], last[i])
                if b.fragment[i] == f.at:
                    rows = rows[rows != b.place[i]]

                def wanted(lower, upper, i=i):
                    least = best.floor[i]
                    if len(lower) > k:
                        least = max(least, np.partition(lower, len(lower) - k)[len(lower) - k])
                    return upper >= least

                at, score = _scan(dims, rows, vector[i], b.order[i], low[i], high[i], wanted)
                best.add(i, score, f.ids[at])
        slot, ids, score = best.rows()
        if len(slot):
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "id": pa.array(ids), "score": pa.array(score)})

    return run


class Windows(NamedTuple):
    """Score windows of a block: one per anchor and positive, anchors ascending; ``first``: each anchor's first window."""

    anchor: np.ndarray
    positive: np.ndarray
    score: np.ndarray
    least: np.ndarray
    most: np.ndarray
    first: np.ndarray


def _negatives(block, windows, floor: np.ndarray, k: int) -> Callable:
    """A mapInArrow function: the task's best rows of other labels in each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, windows.value
        best = Best(floor, k)
        anchors = np.flatnonzero(np.diff(w.first))
        top = np.full(len(b.ids), LOWEST)
        top[anchors] = np.maximum.reduceat(w.most, w.first[anchors]) if len(anchors) else LOWEST
        for f in _read(batches, b.vector.shape[1]):
            dims, vector = _typed(b, f)
            low, high = _remaining(b, f)
            first, last = np.searchsorted(f.labels, b.label), np.searchsorted(f.labels, b.label, "right")
            every = np.arange(len(f.ids))
            for i in anchors:
                own = slice(w.first[i], w.first[i + 1])
                if high[i, 0] < best.floor[own].min() or low[i, 0] > top[i]:
                    continue

                def wanted(lower, upper, own=own):
                    return ((upper >= best.floor[own, None]) & (lower <= w.most[own, None])).any(0)

                rows = np.concatenate([every[: first[i]], every[last[i] :]])
                at, score = _scan(dims, rows, vector[i], b.order[i], low[i], high[i], wanted)
                for j in range(own.start, own.stop):
                    inside = (score >= best.floor[j]) & (score <= w.most[j])
                    if inside.any():
                        best.add(j, score[inside], f.ids[at[inside]])
        slot, ids, score = best.rows()
        if len(slot):
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "id": pa.array(ids), "score": pa.array(score)})

    return run


def _seed_scores(block: Block, rows: slice) -> Iterator[tuple[int, np.ndarray]]:
    """Exact scores of each anchor of ``rows`` with the block's first SEED_ROWS anchors."""
    peak = int(np.abs(block.vector).max(initial=0))
    v = block.vector.astype(number_type(peak, block.vector.shape[1]))
    scores = (v[rows] @ v[:SEED_ROWS].T).astype(np.int64)
    return zip(range(rows.start, rows.stop), scores, strict=True)


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else LOWEST


def _first_floors(block: Block, k: int) -> np.ndarray:
    """Scores that the k-th best row of an anchor's own label reaches at least: those of the block's own rows."""
    floor = np.full(len(block.ids), LOWEST)
    few = slice(0, SEED_ROWS)
    for a in range(0, len(floor), 512):
        for i, scores in _seed_scores(block, slice(a, min(a + 512, len(floor)))):
            mine = block.label[few] == block.label[i]
            if i < SEED_ROWS:
                mine[i] = False
            floor[i] = _kth(scores[mine], k)
    return floor


def _window_floors(block: Block, w: Windows, k: int) -> np.ndarray:
    """The least score of each window, raised to the k-th best that the block's own rows have in it."""
    floor = w.least.copy()
    for a in range(0, len(block.ids), 512):
        for i, scores in _seed_scores(block, slice(a, min(a + 512, len(block.ids)))):
            other = scores[block.label[:SEED_ROWS] != block.label[i]]
            for j in range(w.first[i], w.first[i + 1]):
                floor[j] = max(floor[j], _kth(other[(other >= w.least[j]) & (other <= w.most[j])], k))
    return floor


def _top(found: DataFrame, k: int) -> DataFrame:
    """slot, id, score and rank of the best ``k`` per slot; Spark limits each task's rows ahead of the shuffle."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, vector: str = "embedding", label: str | Column = "label", id_col: str = "vec_id", every: int = 50,
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256,
    fragment_rows: int = FRAGMENT_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every id that ``every`` divides.

    ``label``: a column or an expression. A negative's score is from ``least``
    to ``most`` per cent of its positive's.
    """
    spark = vectors.sparkSession
    of = F.col(label) if isinstance(label, str) else label
    rows = vectors.where(usable(vector)).select(F.col(id_col).cast("long").alias("id"), of.cast("long").alias("label"), F.col(vector).alias("t"))
    rows = rows.where("label IS NOT NULL")
    width = longest(rows, "t")
    table = materialise(fragments(rows, width, scale, fragment_rows), "fragments")
    total = rows.where(F.col("id") % every == 0).count()
    blocks = -(-total // block_anchors)
    anchors = materialise(_anchors(table, width, every, max(blocks, 1)), "anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    done = []
    for n in range(blocks):
        block = _block(anchors.where(F.col("block") == n), width)
        if not len(block.ids):
            continue
        sent = spark.sparkContext.broadcast(block)
        near = _top(table.mapInArrow(_positives(sent, _first_floors(block, positives), positives), "slot long, id long, score long"), positives)
        near = near.orderBy("slot", "rank").toArrow()  # at most ``positives`` rows per anchor of the block
        slot, ids, score = (near.column(c).to_numpy() for c in ("slot", "id", "score"))
        low, high = -((-least * score) // 100), (most * score) // 100
        some = low <= high
        slot, ids, score, low, high = slot[some], ids[some], score[some], low[some], high[some]
        windows = Windows(slot, ids, score, low, high, np.searchsorted(slot, np.arange(len(block.ids) + 1)))
        sent_windows = spark.sparkContext.broadcast(windows)
        floor = _window_floors(block, windows, negatives)
        hard = _top(table.mapInArrow(_negatives(sent, sent_windows, floor, negatives), "slot long, id long, score long"), negatives)
        done.append(materialise(hard.mapInArrow(_named(sent, sent_windows), schema), "negatives"))
        sent.unpersist()
        sent_windows.unpersist()
    discard(table, anchors)
    out = spark.createDataFrame([], schema)
    for part in done:
        out = part if part is done[0] else out.unionByName(part)
    return out


def _named(block, windows) -> Callable:
    """A mapInArrow function: anchors, positives and ids in place of slots."""

    def ids(values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int64(), mask=values == NO_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, windows.value
        for batch in batches:
            slot = np.asarray(batch.column("slot"))
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor_id": ids(b.ids[w.anchor[slot]]), "positive_id": ids(w.positive[slot]),
                    "rank": batch.column("rank").cast(pa.int32()), "negative_id": ids(np.asarray(batch.column("id"))),
                    "positive_score": pa.array(w.score[slot]), "negative_score": batch.column("score"),
                }
            )

    return run
