"""Helpers on Arrow text columns: words, word hashes, exact n-gram ranks.

All functions work on one Arrow column at a time inside a Spark task. Callers
cut batches with ``pieces`` first, so memory is bounded by ``PIECE_BYTES`` or
one document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

PIECE_BYTES = 1 << 20

#: Byte tables: True where a byte belongs to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTER_DIGIT = np.zeros(256, bool)
LETTER_DIGIT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Words of more bytes are hashed and compared one by one.
LONG_WORD = 64
#: The low bytes of a block that a word reaches into.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


class Words(NamedTuple):
    """Words of a column: byte buffer, word starts/ends in it, first word of each row (one more than rows)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous string array, nulls read as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if column.null_count else column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows."""
    column = plain(column)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = column.buffers()[2]
    data = np.zeros(0, np.uint8) if buf is None else np.frombuffer(buf, np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of each piece has at most ``limit`` bytes (or is one row)."""
    at = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(text) if at is None else at
        off = text_bytes(batch.column(at))[1]
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def split_words(column: pa.Array, table: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of the bytes in ``table`` within each row; A-Z in lower case on request."""
    data, off = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = table[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[off[1:][np.diff(off) > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, off))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE_BYTES + 1024)
        inverse = pow(_BASE, -1, 2**64)
        _POWERS[:] = []
        for base in (_BASE, inverse):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (zeros behind the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word: its length and 8-byte blocks, scrambled one after the other; XXH64 for long words.

    Equal words have equal hashes. The converse is only likely: see ``same_words`` and ``word_ranks``.
    """
    size = w.end - w.start
    blocks = _blocks(w.data)
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    live = np.flatnonzero(size <= LONG_WORD)
    for j in range(0, LONG_WORD, 8):
        live = live[size[live] > j]
        if not len(live):
            break
        block = blocks[w.start[live] + j] & _MASKS[np.minimum(size[live] - j, 8)]
        h[live] = mix(h[live] ^ block)
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(w.data[w.start[i] : w.end[i]])
    return h


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word ``i[k]`` of ``a`` has the bytes of word ``j[k]`` of ``b``, for each k."""
    size = a.end[i] - a.start[i]
    same = size == b.end[j] - b.start[j]
    p, q = a.start[i], b.start[j]
    if a.data is b.data:
        live = np.flatnonzero(same & (p != q))
    else:
        live = np.flatnonzero(same)
    long = live[size[live] > LONG_WORD]
    live = live[size[live] <= LONG_WORD]
    if len(live):
        left = _blocks(a.data)
        right = left if a.data is b.data else _blocks(b.data)
        for at in range(0, LONG_WORD, 8):
            live = live[size[live] > at]
            if not len(live):
                break
            equal = ((left[p[live] + at] ^ right[q[live] + at]) & _MASKS[np.minimum(size[live] - at, 8)]) == 0
            same[live[~equal]] = False
            live = live[equal]
    for k in long:
        same[k] = np.array_equal(a.data[p[k] : p[k] + size[k]], b.data[q[k] : q[k] + size[k]])
    return same


class Ranked(NamedTuple):
    """``rank``: of each word among the different words, in order of their hashes; ``first``: a word of each rank; ``hashes``: of each rank."""

    rank: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def word_ranks(w: Words) -> Ranked:
    """Words have one rank exactly if their bytes are equal: hashes sort them, bytes decide."""
    hashes = word_hashes(w)
    rank, order, distinct = dense_rank(hashes)
    first = order[np.flatnonzero(np.diff(rank[order], prepend=-1))]
    other = np.flatnonzero(~same_words(w, np.arange(len(rank)), w, first[rank]))
    if len(other):  # different words of one hash
        sub = np.zeros(len(rank), np.int64)
        for r in np.unique(rank[other]):
            members = np.flatnonzero(rank == r)
            spelt = [w.data[w.start[i] : w.end[i]].tobytes() for i in members]
            place = {x: i for i, x in enumerate(sorted(set(spelt)))}
            sub[members] = [place[x] for x in spelt]
        rank, order, distinct = dense_rank(rank * (int(sub.max()) + 1) + sub)
        first = order[np.flatnonzero(np.diff(rank[order], prepend=-1))]
    return Ranked(rank, first, hashes[first])


def row_of(w: Words) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))


def dense_rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(rank of each key among the distinct keys, order that sorts them, number of distinct keys)."""
    order = np.argsort(keys)
    s = keys[order]
    step = np.ones(len(s), np.int64)
    step[1:] = s[1:] != s[:-1]
    ranks = np.empty(len(s), np.int64)
    step = np.cumsum(step)
    ranks[order] = step - 1
    return ranks, order, int(step[-1]) if len(s) else 0


def ngram_ranks(ids: np.ndarray, stop: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank the k-grams that start at each position, by doubling; returns (ranks from 1, order).

    ``ids``: rank of the word at each position, from 0. ``stop``: end of the row
    that holds a position; a k-gram ends there at the latest and a shorter one
    sorts before its extensions. Two positions get one rank exactly if their
    k-grams (cut at the row's end) are equal.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    left = stop - at
    ranks, order, distinct = dense_rank(ids)
    ranks += 1
    have = 1
    while have < k and distinct < n:
        bits = int(distinct + 1).bit_length()
        more = max(1, min(63 // bits - 1, -(-(k - have) // have)))
        key = ranks.astype(np.int64)
        for j in range(1, more + 1):
            shift = min(j * have, k - have)
            ahead = np.zeros(n, np.int64)
            ok = left > shift
            ahead[ok] = ranks[at[ok] + shift]
            key = (key << bits) | ahead
        ranks, order, distinct = dense_rank(key)
        ranks += 1
        have = min(k, have + more * have)
    return ranks, order


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... (count[i] values) for every i, one after the other."""
    total = int(count.sum())
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def by_piece(text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], limit: int = PIECE_BYTES) -> Callable:
    """A mapInArrow function that applies ``fn`` to pieces of bounded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, limit):
            out = fn(piece)
            if out is not None and out.num_rows:
                yield out

    return run


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int, most: int | None = None
) -> Iterator[tuple[pa.Table, bool]]:
    """Regroup sorted batches into (table, True) of about ``rows`` rows that never cut a group of equal ``keys``.

    A group of over ``most`` rows comes in (table, False) parts instead, each
    holding rows of that group only, so no group has to fit in memory.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    large = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows and large is None:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        if large is not None:
            same = np.ones(table.num_rows, bool)
            for k, v in zip(keys, large, strict=True):
                same &= table.column(k).to_numpy() == v
            n = int(same.sum())
            if n:
                yield table.slice(0, n), False
                table = table.slice(n)
            if table.num_rows:
                large = None
        cut = last_change(table, keys) if table.num_rows >= rows else 0
        if cut:
            yield table.slice(0, cut), True
            table = table.slice(cut)
        elif most is not None and table.num_rows > most:
            large = [table.column(k)[0].as_py() for k in keys]
            yield table, False
            table = table.slice(0, 0)
        held = table.to_batches()
        count = table.num_rows
    if count:
        yield pa.Table.from_batches(held).combine_chunks(), True


def last_change(table: pa.Table, keys: list[str]) -> int:
    """The last row whose keys differ from the row before; 0 if there is none."""
    step = np.zeros(max(table.num_rows - 1, 0), bool)
    for k in keys:
        v = table.column(k).to_numpy()
        step |= v[1:] != v[:-1]
    at = np.flatnonzero(step)
    return int(at[-1]) + 1 if len(at) else 0


def join_words(w: Words, table: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by one space; ``table``: the bytes that made the words."""
    size = w.end - w.start
    kept_bytes = w.data[table[w.data]][np.repeat(keep, size)]
    size, row = size[keep], row_of(w)[keep]
    gap = np.zeros(len(size), np.int64)
    gap[:-1] = row[1:] == row[:-1]
    total = int((size + gap).sum())
    out = np.full(total, 0x20, np.uint8)
    letter = np.ones(total, bool)
    letter[(np.cumsum(size + gap) - 1)[gap > 0]] = False
    out[letter] = kept_bytes
    length = np.bincount(row, weights=size + gap, minlength=len(w.rows) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(length), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])
