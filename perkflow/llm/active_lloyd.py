"""Vector code compression: one codebook per part of the vector, trained by active-entry Lloyd rounds.

Components become integers, floor(scale * x); a vector is cut into ``parts``
equal consecutive parts and each part is coded by the index of its nearest
codebook entry (squared Euclidean distance, ties to the lower index).

Each row carries the entry and the exact distance of every part from round to
round. After an update only some entries have moved. A part whose own entry
stayed where it was keeps its stored distance and is compared with the moved
entries alone: all others are as far as they were, and were no better. A part
whose entry moved is compared with the whole codebook. So the work of a round
shrinks with the number of moved entries, and the result equals a full scan.

Spark's work: a narrow pass per round, written to the shared folder; sums per
(part, entry) of each task, added up by one small aggregation. Codebooks are
``entries`` vectors, whatever the table's size; they alone meet on the driver.

Defined cases. Null vectors and vectors with a null or non-finite component
are dropped. Vectors shorter than the longest end in zeros, as does a length
that ``parts`` doesn't divide; an empty vector is all zeros. Scaled components
are held within +-2**24; a label's sum beyond 64 bits is null. The first
entries come from the rows in order of ``order`` (nulls last, equal ones by
their vector); with fewer rows than entries there are as many entries as rows.
Repeated rows are rows of their own. An empty table has no codebook and no
codes. There is no text; other columns travel as one struct, so their names
can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.components import discard, materialise
from perkflow.llm.vectors import binary, longest, number_type, rows_of, scaled, usable

#: Rows whose distances to a codebook are held at a time.
BLOCK_ROWS = 4096


class Encoded(NamedTuple):
    """``rows``: row (the kept columns), code (a byte per part), error; ``books``: part x entry x position."""

    rows: DataFrame
    books: np.ndarray


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest index among the nearest entries, exact squared distance) of every row of ``x``."""
    entry, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    norm = (book * book).sum(1)
    for a in range(0, len(x), BLOCK_ROWS):
        y = x[a : a + BLOCK_ROWS]
        d = (y * y).sum(1)[:, None] - 2 * (y @ book.T) + norm
        best = d.argmin(1)
        entry[a : a + BLOCK_ROWS] = best
        distance[a : a + BLOCK_ROWS] = d[np.arange(len(y)), best]
    return entry, distance


def reassign(x: np.ndarray, entry: np.ndarray, distance: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries and distances after ``moved`` entries of ``book`` changed, from those before."""
    entry, distance = entry.copy(), distance.copy()
    stale = moved[entry]
    again, still, active = np.flatnonzero(stale), np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(again):
        entry[again], distance[again] = nearest(x[again], book)
    if len(active) and len(still):
        at, d = nearest(x[still], book[active])
        at = active[at]
        better = (d < distance[still]) | ((d == distance[still]) & (at < entry[still]))
        entry[still[better]], distance[still[better]] = at[better], d[better]
    return entry, distance


def updated(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of their parts' mean; unused entries stay."""
    return np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)


def _assign(books: np.ndarray, moved: np.ndarray | None, scale: int, last: bool) -> Callable:
    """A mapInArrow function that codes vectors (``moved``: None) or codes that are there anew."""
    parts, _, part_width = books.shape
    width = parts * part_width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if moved is None:
                v = scaled(batch.column("t"), scale, width)
                entry, distance = np.empty((len(v), parts), np.int64), np.empty((len(v), parts), np.int64)
            else:
                v = rows_of(batch.column("v"), np.int32, width).astype(np.int64)
                entry = rows_of(batch.column("code"), np.uint8, parts).astype(np.int64)
                distance = rows_of(batch.column("far"), np.int64, parts)
            number = number_type(int(max(np.abs(v).max(initial=0), np.abs(books).max(initial=0))), part_width)
            for p in range(parts):
                x, book = v[:, p * part_width : (p + 1) * part_width].astype(number), books[p].astype(number)
                if moved is None:
                    entry[:, p], distance[:, p] = nearest(x, book)
                else:
                    entry[:, p], distance[:, p] = reassign(x, entry[:, p], distance[:, p], book, moved[p])
            out = {"row": batch.column("row"), "code": binary(entry.astype(np.uint8))}
            if last:
                out["error"] = pa.array(distance.sum(1), pa.int64())
            else:
                out |= {"v": binary(v.astype(np.int32)), "far": binary(distance)}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _task_sums(parts: int, entries: int, part_width: int) -> Callable:
    """A mapInArrow function: count and component sums of every (part, entry) that a task's rows use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, part_width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            v = rows_of(batch.column("v"), np.int32, parts * part_width).astype(np.int64).reshape(-1, part_width)
            slot = (rows_of(batch.column("code"), np.uint8, parts) + np.arange(parts) * entries).ravel()
            counts += np.bincount(slot, minlength=len(counts))
            np.add.at(sums, slot, v)
        used = np.flatnonzero(counts)
        if len(used):
            columns = {f"s{i}": pa.array(sums[used, i]) for i in range(part_width)}
            yield pa.RecordBatch.from_pydict({"slot": pa.array(used), "n": pa.array(counts[used]), **columns})

    return run


def _totals(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and counts of all entries: at most parts * entries rows reach the driver."""
    parts, entries, part_width = books.shape
    names = ["n", *[f"s{i}" for i in range(part_width)]]
    schema = ", ".join(f"{c} long" for c in ["slot", *names])
    each = state.select("v", "code").mapInArrow(_task_sums(parts, entries, part_width), schema)
    sums, counts = np.zeros((parts * entries, part_width), np.int64), np.zeros(parts * entries, np.int64)
    for r in each.groupBy("slot").agg(*[F.sum(c).alias(c) for c in names]).collect():
        counts[r["slot"]] = r["n"]
        sums[r["slot"]] = r[2:]
    return sums.reshape(books.shape), counts.reshape(parts, entries)


def encode(
    vectors: DataFrame, vector: str = "embedding", order: str = "vec_id", parts: int = 16, entries: int = 64, rounds: int = 2,
    scale: int = 256, keep: Sequence[str] | None = None,
) -> Encoded:
    """Codes of all usable vectors and the codebooks; ``keep``: columns of ``row`` (default: all but the vector)."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has to fit in one byte")
    kept = [F.col(c) for c in (vectors.columns if keep is None else keep) if c != vector] or [F.lit(0).alias("none")]
    rows = vectors.where(usable(vector)).select(F.struct(*kept).alias("row"), F.col(order).alias("o"), F.col(vector).alias("t"))
    part_width = -(-max(longest(rows, "t"), 1) // parts)
    width = parts * part_width
    first = rows.select("o", "t").orderBy(F.col("o").asc_nulls_last(), "t").limit(entries).select("t").toArrow()
    start = scaled(first.column("t"), scale, width) if first.num_rows else np.zeros((0, width), np.int64)
    books = start.reshape(len(start), parts, part_width).transpose(1, 0, 2).copy()
    row_type = rows.schema["row"].dataType.simpleString()
    if not len(start):
        return Encoded(rows.select("row", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), books)

    def pass_over(table: DataFrame, moved: np.ndarray | None, last: bool) -> DataFrame:
        schema = f"row {row_type}, code binary, " + ("error long" if last else "v binary, far binary")
        return materialise(table.mapInArrow(_assign(books, moved, scale, last), schema), "codes")

    state, moved = rows.select("row", "t"), None
    for _ in range(rounds):
        before, state = state, pass_over(state, moved, False)
        if moved is not None:
            discard(before)
        changed = updated(books, *_totals(state, books))
        moved, books = (changed != books).any(2), changed
    out = pass_over(state, moved, True)
    if moved is not None:
        discard(state)
    return Encoded(out, books)


def label_errors(encoded: Encoded, label: str) -> DataFrame:
    """The rows with ``label_error``: the error summed over all rows of an equal label, nulls together."""
    of = F.col("row")[label]
    by = materialise(encoded.rows.groupBy(of.alias("l")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return encoded.rows.join(by, of.eqNullSafe(F.col("l"))).drop("l")


def decode(code: bytes, books: np.ndarray, scale: int = 256) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p][e] for p, e in enumerate(code)]) / scale
