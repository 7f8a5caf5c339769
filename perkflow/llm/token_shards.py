"""Token ids in wavelet-matrix shards.

Documents are range-partitioned and sorted by id; every Spark task tokenizes
its range and cuts the ids into shards of about ``SHARD_TOKENS``. A shard is
one compressed file image: document ids and lengths, and the ids as a wavelet
matrix, that is one bit-plane per bit of an id (highest first, each plane in
the stable order that the planes above it leave), with ranks per block and
the blocks compressed one by one. From that image alone ``WaveletMatrix``
answers access, counting and occurrence lookup without decoding the shard.

Images are rows of a Parquet table, so Spark's committer makes the write safe
against lost executors and the files can lie in any store that Spark reads.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perkflow.llm.text import LOWER, Words, dense_rank, expand, pieces, plain, same_words, word_hashes

SHARD_TOKENS = 1 << 20
BLOCK_BITS = 1 << 16
#: Parts that an encoder remembers before it starts afresh (about 60 bytes each).
MEMO_PARTS = 3_000_000
#: Parts learnt before they are merged into the large sorted arrays.
LATEST_PARTS = 100_000

_HEAD = struct.Struct("<4sIQQ")
_MAGIC = b"WVM1"


class WaveletMatrix:
    """Rank/select structure over one shard's ids, read from its image block by block."""

    def __init__(self, image: bytes):
        magic, self.bits, self.n, docs = _HEAD.unpack_from(image)
        if magic != _MAGIC:
            raise ValueError("not a shard image")
        self._image, at = image, _HEAD.size

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(image, kind, count, at)
            at += out.nbytes
            return out

        self.zeros = take("<u8", self.bits).astype(np.int64)
        self.doc_ids, self.doc_known, self.doc_sizes = take("<i8", docs), take("u1", docs), take("<u4", docs)
        blocks = -(-self.n // BLOCK_BITS)
        self.ones = take("<u4", self.bits * (blocks + 1)).reshape(self.bits, blocks + 1).astype(np.int64)
        sizes = take("<u4", self.bits * blocks).astype(np.int64)
        self._offset = (at + np.cumsum(sizes) - sizes).reshape(self.bits, blocks)
        self._size = sizes.reshape(self.bits, blocks)
        self._zstd = zstandard.ZstdDecompressor()
        self._last: dict[int, tuple[int, np.ndarray]] = {}

    @staticmethod
    def build(ids: np.ndarray, bits: int, doc_ids: list, doc_sizes: np.ndarray) -> bytes:
        """The image of ``ids`` (all below 2**bits) of consecutive documents."""
        a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        n, blocks = len(a), -(-len(a) // BLOCK_BITS)
        zeros, ones, sizes, data = [], [], [], []
        zstd = zstandard.ZstdCompressor(level=1)
        for level in range(bits):
            bit = (a & a.dtype.type(1 << (bits - 1 - level))) != 0
            plane = np.packbits(bit, bitorder="little")
            counts = np.add.reduceat(np.bitwise_count(plane).astype(np.int64), np.arange(blocks) * (BLOCK_BITS // 8)) if n else []
            ones.append(np.concatenate([[0], np.cumsum(counts)]))
            zeros.append(n - int(ones[-1][-1]))
            for b in range(blocks):
                packed = zstd.compress(plane[b * BLOCK_BITS // 8 : (b + 1) * BLOCK_BITS // 8].tobytes())
                sizes.append(len(packed))
                data.append(packed)
            if level < bits - 1:
                a = np.concatenate([a[~bit], a[bit]])
        known = np.array([d is not None for d in doc_ids], np.uint8)
        return b"".join(
            [
                _HEAD.pack(_MAGIC, bits, n, len(doc_ids)), np.array(zeros, "<u8").tobytes(),
                np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), known.tobytes(),
                doc_sizes.astype("<u4").tobytes(), np.concatenate(ones).astype("<u4").tobytes(),
                np.array(sizes, "<u4").tobytes(), *data,
            ]
        )

    def _block(self, level: int, b: int) -> np.ndarray:
        """Bits of one block; the last one of each level is kept."""
        if self._last.get(level, (-1,))[0] != b:
            at, size = int(self._offset[level, b]), int(self._size[level, b])
            raw = self._zstd.decompress(self._image[at : at + size])
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
            self._last[level] = (b, bits[: min(BLOCK_BITS, self.n - b * BLOCK_BITS)])
        return self._last[level][1]

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        b, rest = divmod(i, BLOCK_BITS)
        return int(self.ones[level, b]) + (int(self._block(level, b)[:rest].sum()) if rest else 0)

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0, ascending) ones or zeros of a plane."""
        before = self.ones[level] if bit else np.minimum(np.arange(self.ones.shape[1]) * BLOCK_BITS, self.n) - self.ones[level]
        block = np.searchsorted(before, k, "right") - 1
        out = np.empty(len(k), np.int64)
        for b in np.unique(block):
            mine = block == b
            out[mine] = b * BLOCK_BITS + np.flatnonzero(self._block(level, int(b)) == bit)[k[mine] - before[b]]
        return out

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for level in range(self.bits):
            bit = int(self._block(level, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._rank1(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = 2 * value + bit
        return value

    def _interval(self, token: int) -> tuple[int, int]:
        lo, hi = 0, self.n
        for level in range(self.bits):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if token >> (self.bits - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int) -> int:
        """How often an id occurs."""
        if token < 0 or token >> self.bits:
            return 0
        lo, hi = self._interval(token)
        return hi - lo

    def locate(self, token: int) -> np.ndarray:
        """All positions of an id, ascending."""
        if token < 0 or token >> self.bits:
            return np.zeros(0, np.int64)
        at = np.arange(*self._interval(token))
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select(level, bit, at - (int(self.zeros[level]) if bit else 0))
        return at

    def decode(self) -> np.ndarray:
        """All ids of the shard."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            blocks = range(self._size.shape[1])
            raw = b"".join([self._zstd.decompress(self._image[self._offset[level, b] : self._offset[level, b] + self._size[level, b]]) for b in blocks])
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=self.n).view(bool)
            up = np.empty_like(cur)
            z = int(self.zeros[level])
            up[~bit] = cur[:z]
            up[bit] = cur[z:] | kind(1 << (self.bits - 1 - level))
            cur = up
        return cur


#: Kinds of bytes. 0: space or line feed, 1: ASCII letter or part of a Latin-1 letter, 2: other visible ASCII but the
#: apostrophe, 3: anything else.
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, 0x0A]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalpha() and c != 0x27]] = 2


def byte_kinds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each byte, bytes in lower case) of UTF-8 text; a chunk between spaces that holds kind 3 is all kind 3, as written."""
    kind, low = _KIND[raw], LOWER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    second = raw[lead + 1]
    lead = lead[(second >= 0x80) & (second != 0x97) & (second != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    low[lead + 1] += np.where(raw[lead + 1] <= 0x9E, 0x20, 0).astype(np.uint8)
    kind[np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))] = 3  # "<|" may begin a special token
    if (kind == 3).any():
        edge = np.diff(np.concatenate([[0], (kind != 0).astype(np.int8), [0]]))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        odd = np.concatenate([[0], np.cumsum(kind == 3)])
        whole = odd[end] > odd[start]
        kind[expand(start[whole], end[whole] - start[whole])] = 3
        low = np.where(kind == 3, raw, low)
    return kind, low


class Encoder:
    """The tokenizers library behind a memory of parts already encoded.

    This family of tokenizers (lower case; letters, single digits and other
    characters apart; white space dropped) encodes chunks between spaces, and
    in them runs of letters and of signs, independently of their neighbours.
    So each different run is encoded once. A chunk with an apostrophe, "<|", a
    control character or any character but ASCII and Latin-1 letters is one
    part as it stands. Parts are looked up by a 64-bit hash and compared by
    their bytes; texts in which two parts share a hash, among themselves or
    with a remembered one, go to the library whole. ``splits`` says whether
    the tokenizer is of that family; if not, it gets whole texts.
    """

    def __init__(self, tokenizer: Tokenizer, end_id: int, splits: bool):
        self.tokenizer, self.end_id, self.splits = tokenizer, end_id, splits
        self._reset()

    def _reset(self) -> None:
        nothing = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4)
        #: sorted keys, places in ids, numbers of ids, first and last place in spelt: of most parts, and of the latest
        self.known, self.latest = nothing, nothing
        self.ids = np.array([self.end_id], np.uint32)
        self.spelt = np.zeros(0, np.uint8)

    def _find(self, keys: np.ndarray, w: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(place, number of ids) of each part, ``first``: a word of each; place -1 for a new one. None if hashes mislead."""
        at, size = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for own, places, sizes, start, end in (self.known, self.latest):
            if len(own):
                slot = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = np.flatnonzero(own[slot] == keys)
                slot = slot[hit]
                at[hit], size[hit] = places[slot], sizes[slot]
                if not same_words(w, first[hit], Words(self.spelt, start, end, start), slot).all():
                    return None
        return at, size

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        keys = np.concatenate([a[0], b[0]])
        sort = np.argsort(keys)
        return (keys[sort], *(np.concatenate([x, y])[sort] for x, y in zip(a[1:], b[1:], strict=True)))

    def _learn(self, keys: np.ndarray, spelt: list[bytes], word: np.ndarray) -> None:
        """Encode new parts; those marked ``word`` are runs of letters, which the library takes in one go."""
        parts = [p.decode() for p in spelt]
        letters = [p for p, w in zip(parts, word, strict=True) if w]
        got = self.tokenizer.encode(" ".join(letters), add_special_tokens=False) if letters else None
        sizes = np.zeros(len(parts), np.int64)
        ids = [self.ids]
        if letters:
            sizes[word] = np.bincount(np.array(got.word_ids, np.int64), minlength=len(letters))
            ids.append(np.array(got.ids, np.uint32))
        others = self.tokenizer.encode_batch_fast([p for p, w in zip(parts, word, strict=True) if not w], add_special_tokens=False)
        sizes[~word] = [len(e.ids) for e in others]
        ids += [np.array(e.ids, np.uint32) for e in others]
        order = np.concatenate([np.flatnonzero(word), np.flatnonzero(~word)])
        at = np.empty(len(parts), np.int64)
        at[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.ids = np.concatenate(ids)
        end = len(self.spelt) + np.cumsum([len(p) for p in spelt])
        start = end - [len(p) for p in spelt]
        self.spelt = np.concatenate([self.spelt, np.frombuffer(b"".join(spelt), np.uint8)])
        self.latest = self._merged(self.latest, (keys, at, sizes, start, end))
        if len(self.latest[0]) > LATEST_PARTS:
            self.known = self._merged(self.known, self.latest)
            self.latest = tuple(x[:0] for x in self.latest)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, by the library alone."""
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        each = [np.array([*e.ids, self.end_id], np.uint32) for e in got]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id; number of ids of each text."""
        if not self.splits:
            return self._whole(texts)
        raw = [t.encode() for t in texts]
        ends = np.cumsum([len(r) + 1 for r in raw])
        kind, buf = byte_kinds(np.frombuffer(b" ".join(raw) + b" ", np.uint8))
        change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        start = np.concatenate([[0], change])
        end = np.append(change, len(buf))
        real = kind[start] != 0
        start, end = start[real], end[real]
        w = Words(buf, start, end, np.searchsorted(start, np.concatenate([[0], ends])))
        hashes = word_hashes(w)
        rank, order, distinct = dense_rank(hashes)
        first = order[np.flatnonzero(np.diff(rank[order], prepend=-1))]
        keys = hashes[first]
        if not same_words(w, np.arange(len(rank)), w, first[rank]).all():
            return self._whole(texts)
        if len(self.known[0]) + len(self.latest[0]) + distinct > MEMO_PARTS:
            self._reset()
        found = self._find(keys, w, first)
        if found is None:
            return self._whole(texts)
        place, count = found
        if (place < 0).any():
            text = buf.tobytes()
            new = first[place < 0]
            parts = [text[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            self._learn(keys[place < 0], parts, kind[start[new]] == 1)
            place, count = self._find(keys, w, first)
        at = np.insert(place[rank], w.rows[1:], 0)
        size = np.insert(count[rank], w.rows[1:], 1)
        sums = np.concatenate([[0], np.cumsum(size)])
        bounds = sums[w.rows + np.arange(len(w.rows))]
        return self.ids[expand(at, size)], np.diff(bounds)


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Broadcast, end_id: int) -> Encoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    key = (hash(vocabulary.value), end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        tokenizer = Tokenizer.from_str(vocabulary.value)
        _ENCODERS[key] = Encoder(tokenizer, end_id, splits_words(tokenizer))
    return _ENCODERS[key]


def splits_words(tokenizer: Tokenizer) -> bool:
    """Whether letter runs and sign runs are encoded independently, by a probe of mixed runs."""
    def ids(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    runs = ["Ab", "12#", "zebraé", "--", "Ünten", "7", "q", "...", "straße", "(", "anthe", ",\"", "s", "!?"]
    sole = [ids(r.lower()) for r in runs]
    word = tokenizer.encode("zebra anthe q", add_special_tokens=False).word_ids
    return (
        ids("".join(runs)) == sum(sole, []) and ids(" ".join(runs)) == sum(sole, []) and ids("\n".join(runs)) == sum(sole, [])
        and sorted(set(word)) == [0, 1, 2]
    )


def write_shards(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Tokenize all of ``docs`` and write the shards to ``path`` in ascending id order.

    Nulls and empty texts are documents of the end id alone. Null ids come
    first; rows of equal id follow by text hash; a document longer than a shard
    gets a shard of its own. An empty table writes an empty set of shards.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # the vocabulary file, of fixed size
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    rows = rows.repartitionByRange("d", "h").sortWithinPartitions("d", "h").select("d", "t", F.spark_partition_id().alias("part"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(vocabulary, end_id)
        bits = max(1, int(max(enc.tokenizer.get_vocab_size() - 1, end_id)).bit_length())
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        count = before = seq = 0

        def flush(part: int) -> pa.RecordBatch:
            nonlocal held, count, before, seq
            ids, sizes = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            image = WaveletMatrix.build(ids, bits, [d for x in held for d in x[0]], sizes)
            out = {"part": [part], "seq": [seq], "before": [before], "n_docs": [len(sizes)], "n_tokens": [len(ids)], "image": [image]}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            held, count, before, seq = [], 0, before + len(ids), seq + 1
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

        part = 0
        for piece in pieces(batches, "t", 1 << 20):
            part = piece.column("part")[0].as_py()
            ids, sizes = enc.encode(plain(piece.column("t")).to_pylist())
            if count and count + len(ids) > shard_tokens:
                yield flush(part)
            held.append((piece.column("d").to_pylist(), ids, sizes))
            count += len(ids)
        if count:
            yield flush(part)

    kind = "part int, seq int, before long, n_docs long, n_tokens long, image binary"
    rows.mapInArrow(shards, kind).write.option("compression", "uncompressed").parquet(path)


def shard_table(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``: ids of all shards before each one.

    Only totals per write partition are summed in order and broadcast: one row
    for each partition of the write.
    """
    shards = spark.read.schema("part int, seq int, before long, n_docs long, n_tokens long, image binary").parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("base") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids: little-endian unsigned 32-bit."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image, start in zip(batch.column("image"), batch.column("start").to_pylist(), strict=True):
                m = WaveletMatrix(image.as_py())
                ends = np.cumsum(m.doc_sizes.astype(np.int64))
                raw = pa.py_buffer(m.decode().astype("<u4").tobytes())
                offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), raw])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.doc_ids, mask=m.doc_known == 0), pa.array(start + ends - m.doc_sizes), pa.array(m.doc_sizes.astype(np.int64)), ids],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return shard_table(spark, path).select("image", "start").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each id occurs, counted inside the compressed shards."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image in batch.column("image"):
                m = WaveletMatrix(image.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([m.count(t) for t in tokens], pa.int64())], names=["token", "n"])

    found = spark.read.parquet(path).select("image").mapInArrow(count, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def locate_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, position): every occurrence of an id, by its place in the whole sequence."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image, start in zip(batch.column("image"), batch.column("start").to_pylist(), strict=True):
                m = WaveletMatrix(image.as_py())
                at = m.locate(token)
                row = np.searchsorted(np.cumsum(m.doc_sizes.astype(np.int64)), at, "right")
                doc = pa.array(m.doc_ids[row], mask=m.doc_known[row] == 0)
                yield pa.RecordBatch.from_arrays([doc, pa.array(start + at)], names=["doc_id", "position"])

    return shard_table(spark, path).select("image", "start").mapInArrow(locate, "doc_id long, position long")
