"""SimHash near-duplicates: BK-trees over shards of fingerprints.

Fingerprints within the radius agree on at least one of radius + 1 bit blocks
(on k - radius of k blocks). Every choice of agreeing blocks is a table of
shards keyed by the bits of those blocks, so linked fingerprints meet in at
least one shard. Each shard gets a BK-tree (children keyed by the integer
Hamming distance to the parent), and a search follows only edges between
d - radius and d + radius. A shard's tree goes to the tasks that hold that
shard's queries instead of to all executors: the set of all trees grows with
the corpus and has no size bound, one shard's has (``shard_rows``). Shards
above it are cut into several trees, each searched by all of the shard's
fingerprints.

Tasks emit a spanning forest of the links they find, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm.components import connected_components, materialise
from perkflow.llm.text import NOT_SPACE, by_piece, expand, split_words, whole_groups

SHINGLE = 4
RADIUS = 4
BITS = 64
#: Largest number of fingerprints in one tree.
SHARD_ROWS = 50_000
#: Wanted mean number of fingerprints in a shard; sets the number of blocks.
SHARD_MEAN = 2_000
#: (query, tree node) pairs that a search holds at once.
FRONTIER = 2_000_000


def simhash(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprint of every text in an Arrow column (see ``fingerprints``)."""
    w = split_words(column, NOT_SPACE, lower=True)
    rows = len(w.rows) - 1
    words = np.diff(w.rows)
    size = w.end - w.start
    begin = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
    is_text = np.ones(len(joined), bool)
    is_text[begin + size] = False
    joined[is_text] = w.data[NOT_SPACE[w.data]]
    buf = joined.tobytes()
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    first = expand(w.rows[:-1], count)
    last = np.minimum(first + shingle - 1, np.repeat(w.rows[1:], count) - 1)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(buf[a:b], 42) for a, b in zip(begin[first].tolist(), (begin[last] + size[last]).tolist(), strict=True)),
        np.uint64,
        len(first),
    )
    # Bit counts: eight one-byte counters in a word, over runs of at most 255 shingles of a row.
    runs = -(-count // 255)
    run_row = np.repeat(np.arange(rows), runs)
    run_start = np.repeat(np.cumsum(count) - count, runs) + 255 * expand(np.zeros(rows, np.int64), runs)
    ones = np.zeros((rows, BITS), np.int64)
    if len(h):
        for k in range(8):
            part = (h >> np.uint64(k)) & np.uint64(0x0101010101010101)
            sums = np.add.reduceat(part, run_start).view(np.uint8).reshape(-1, 8).astype(np.int64)
            starts = np.flatnonzero(np.diff(run_row, prepend=-1))
            ones[run_row[starts], k::8] = np.add.reduceat(sums, starts, axis=0)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    return np.where(2 * ones > count[:, None], weights, np.uint64(0)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` (long, the 64 bits) for every row of ``docs``.

    A-Z in lower case; words are runs of other than ASCII white space; shingles
    of ``shingle`` words, repeats included (a shorter text is one shingle, none
    for no words or null: fingerprint 0); a bit is 1 if set in over half of the
    shingles' XXH64 values (seed 42).
    """
    cols = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    schema = T.StructType([f for f in cols.schema.fields if f.name != "t"] + [T.StructField("fp", T.LongType())])

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        fp = simhash(piece.column(piece.num_columns - 1), shingle).view(np.int64)
        return pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(fp)], names=schema.names)

    out = cols.mapInArrow(by_piece("t", one), schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "fp")


class BKForest:
    """BK-trees over the groups of one array (rows of a group adjacent): ``root`` of each group's rows."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        n = len(values)
        self.values = values
        parent = np.full(n, -1, np.int64)
        edge = np.zeros(n, np.int64)
        left, key = np.arange(n), group.astype(np.int64)
        above, dist = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        self.root = None
        while len(left):
            first = np.ones(len(left), bool)
            first[1:] = key[1:] != key[:-1]
            head = left[first][np.cumsum(first) - 1]
            if self.root is None:
                self.root = head
            parent[left[first]] = above[first]
            edge[left[first]] = dist[first]
            rest = ~first
            left, above = left[rest], head[rest]
            dist = np.bitwise_count(values[left] ^ values[above]).astype(np.int64)
            key = above * (BITS + 1) + dist
            order = np.argsort(key, kind="stable")
            left, above, dist, key = left[order], above[order], dist[order], key[order]
        self.child = np.flatnonzero(parent >= 0)
        slot = parent[self.child] * (BITS + 2) + edge[self.child]
        order = np.argsort(slot, kind="stable")
        self.child = self.child[order]
        #: children of node i at distance >= e start at offset[i * (BITS + 2) + e]
        self.offset = np.searchsorted(slot[order], np.arange(n * (BITS + 2) + 1)).astype(np.int32)

    def search(self, query: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays (query index, node) of all pairs within ``radius``, level by level."""
        q, node = np.arange(len(query)), root
        while len(q):
            d = np.bitwise_count(query[q] ^ self.values[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            base = node * (BITS + 2)
            a = self.offset[base + np.maximum(d - radius, 1)].astype(np.int64)
            count = self.offset[base + np.minimum(d + radius, BITS) + 1] - a
            q = np.repeat(q, count)
            node = self.child[expand(a, count)]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest-member labels after linking a[i] with b[i]."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def forest_links(values: np.ndarray, is_node: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the rows: each row searches the tree of its group's node rows."""
    tree_rows = np.flatnonzero(is_node)
    forest = BKForest(values[tree_rows], group[tree_rows])
    first = np.searchsorted(group[tree_rows], group)  # rows are sorted by group
    inside = (first < len(tree_rows)) & (group[tree_rows[np.minimum(first, len(tree_rows) - 1)]] == group)
    queries = np.flatnonzero(inside)
    root = forest.root[first[queries]]
    label = np.arange(len(values))
    sizes = np.bincount(group[tree_rows], minlength=int(group[-1]) + 1)[group[queries]]
    ends = np.cumsum(sizes)
    a = 0
    while a < len(queries):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + FRONTIER, "right")))
        for q, node in forest.search(values[queries[a:b]], root[a:b], radius):
            label = join_labels(label, queries[a:b][q], tree_rows[node])
        a = b
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def _tree(parts: list[np.ndarray]) -> tuple[BKForest, np.ndarray]:
    nodes = np.concatenate(parts)
    return BKForest(nodes, np.zeros(len(nodes), np.int64)), nodes


def tree_links(forest: BKForest, nodes: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of ``queries`` and the rows of one tree (``forest`` over ``nodes``)."""
    values = np.concatenate([nodes, queries])
    label = np.arange(len(values))
    step = max(1, FRONTIER // max(len(nodes), 1))
    for a in range(0, len(queries), step):
        part = queries[a : a + step]
        for q, node in forest.search(part, np.zeros(len(part), np.int64), radius):
            label = join_labels(label, len(nodes) + a + q, node)
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def block_count(classes: int, radius: int = RADIUS, mean: int = SHARD_MEAN) -> int:
    """Number of bit blocks for which a shard of ``classes`` spread fingerprints has at most ``mean`` rows."""
    for blocks in range(radius + 1, radius + 5):
        if classes <= mean * 2 ** (BITS * (blocks - radius) // blocks):
            return blocks
    return radius + 4


def shard_keys(fp: Column, blocks: int, radius: int = RADIUS) -> Column:
    """Array of (table, key) structs: the bits of every choice of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    out = []
    for t, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in kept)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(t).alias("table"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*out)


def near_links(classes: DataFrame, radius: int = RADIUS, blocks: int = RADIUS + 1, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that span every group of distinct fingerprints ``fp`` within ``radius`` bits.

    A shard of over ``shard_rows`` is cut into several trees. A tree's rows come
    before the rows that only search it, and those stream past it in parts, so
    a task holds a tree of about ``shard_rows`` and one part, however large the
    shard.
    """
    shards = classes.select("fp", F.explode(shard_keys(F.col("fp"), blocks, radius)).alias("s")).select("fp", "s.*")
    large = shards.groupBy("table", "key").count().where(F.col("count") > shard_rows)
    large = large.select("table", "key", F.ceil(F.col("count") / shard_rows).cast("int").alias("trees"))
    rows = shards.join(large, ["table", "key"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    rows = rows.select(
        "table", "key", "fp", F.pmod(F.xxhash64("fp"), "trees").cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"),
    )
    rows = rows.select("table", "key", "tree", "fp", (F.col("own") == F.col("tree")).alias("is_node"))
    keys = ["table", "key", "tree"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, forest, nodes = None, [], None, None  # of the tree whose rows come in parts
        for part, whole in whole_groups(batches, keys, min(65_536, 2 * shard_rows), 2 * shard_rows):
            now = None if whole else tuple(part.column(k)[0].as_py() for k in keys)
            if now != key:
                if waiting:
                    yield links(*tree_links(*_tree(waiting), np.concatenate(waiting), radius))
                key, waiting, forest = now, [], None
            values, is_node = part.column("fp").to_numpy().view(np.uint64), part.column("is_node").to_numpy()
            if whole:
                col = [part.column(k).to_numpy() for k in keys]
                step = np.zeros(part.num_rows, np.int64)
                for c in col:
                    step[1:] |= c[1:] != c[:-1]
                yield links(*forest_links(values, is_node, np.cumsum(step), radius))
                continue
            if forest is None:
                waiting.append(values[is_node])
                if is_node.all():
                    continue
                forest, nodes = _tree(waiting)
                values, waiting = np.concatenate([nodes, values[~is_node]]), []
            yield links(*tree_links(forest, nodes, values, radius))
        if waiting:
            yield links(*tree_links(*_tree(waiting), np.concatenate(waiting), radius))

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    rows = rows.repartition(*keys).sortWithinPartitions(*keys, F.desc("is_node"))
    return rows.mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default the id), ``fp`` and ``component_id`` for every row of ``docs``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; a
    component is all rows that links connect, named by its smallest non-null id
    (null if it has none). Rows of equal fingerprint are one class, so copies
    are never paired. Nulls and texts without words have fingerprint 0 and are
    linked like any other; repeated rows and ids keep their rows; an empty
    table gives an empty result. A kept column named like a computed one comes
    back as ``<name>_kept``.
    """
    keep = keep or [doc_id]
    cols = list(dict.fromkeys([*keep, doc_id]))
    own = [f"k{i}" for i in range(len(cols))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(cols, own, strict=True)], F.col(text).alias("body"))
    marked = materialise(fingerprints(rows, own, "body", shingle), "fingerprints")
    classes = materialise(marked.groupBy("fp").agg(F.min(own[cols.index(doc_id)]).alias("low")), "classes")
    links = near_links(classes, radius, block_count(classes.count(), radius))
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "fp")
    known = classes.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = known.groupBy("root").agg(F.min("low").alias("component_id"))
    names = known.join(named, "root").select("fp", "component_id")
    computed = ("fp", "component_id")
    back = [F.col(k).alias(f"{c}_kept" if c.lower() in computed else c) for c, k in zip(cols, own, strict=True) if c in keep]
    return marked.join(names, "fp").select(*back, *computed)


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each near-duplicate component left, all columns kept.

    The row with the component's smallest id stays; among rows of that id the
    one with the smallest text hash (then any of the identical rows). Rows of a
    component without ids are reduced likewise.
    """
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("body"))
    packed = packed.withColumn("k", F.xxhash64("id", "body")).withColumn("k2", F.hash("id", "body"))
    found = near_duplicates(packed.select("id", "body", "k", "k2"), "id", "body", keep=["id", "k", "k2"])
    nameless = F.when(F.col("component_id").isNull(), F.col("fp")).alias("nameless")
    order = F.struct(F.col("id").isNull(), "id", "k", "k2")
    best = found.groupBy("component_id", nameless).agg(F.min(order).alias("best")).select("best.k", "best.k2")
    return packed.join(best, ["k", "k2"], "left_semi").dropDuplicates(["k", "k2"]).select("row.*")
