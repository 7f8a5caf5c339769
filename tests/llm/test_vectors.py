"""Vector codes and hard negatives against brute force, on odd vectors."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm import active_lloyd, bond_negatives, queries

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)
NAN, INF = math.nan, math.inf


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def scaled(v, width):
    return [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (width - len(v))


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """(sorted (vec_id, code, error, label_error), codebooks) by full scans."""
    kept = [r for r in rows if whole(r[1])]
    width = -(-max(len(r[1]) for r in kept) // parts) * parts
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    v = [scaled(r[1], width) for r in kept]
    w = width // parts
    cut = [[x[p * w : (p + 1) * w] for p in range(parts)] for x in v]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def code(part, p):
        far = [(sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[p])]
        return min(far)

    for _ in range(rounds):
        got = [[code(c[p], p)[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got, strict=True) if g[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [[code(c[p], p) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in x) for x in last]
    by = {}
    for r, e in zip(kept, error, strict=True):
        by[r[2]] = by.get(r[2], 0) + e
    out = [(r[0], "".join(f"{i:02x}" for _, i in x), e, by[r[2]]) for r, x, e in zip(kept, last, error, strict=True)]
    return sorted(out, key=str), books


def brute_negatives(rows, every=50, k=5, few=3):
    kept = [(r[0], (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2], r[1]) for r in rows if r[2] is not None and whole(r[1])]
    width = max((len(r[2]) for r in kept), default=0)
    v = [scaled(r[2], width) for r in kept]
    out = []
    for i, a in enumerate(kept):
        if a[0] is None or a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v[i], v[j], strict=True)), r[0] is None, r[0], r[1]) for j, r in enumerate(kept) if j != i]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for p in [s for s in scored if s[3] == a[1]][:k]:
            inside = [s for s in scored if s[3] != a[1] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(a[0], p[2], n, s[2], -p[0], -s[0]) for n, s in enumerate(inside[:few], 1)]
    return sorted(out, key=str)


def random_rows(n, width=32, seed=5, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (labels, width))
    label = rng.integers(0, labels, n)
    v = (centre[label] + rng.normal(0, spread, (n, width))).astype(np.float32)
    return [(i, [float(x) for x in v[i]], int(label[i])) for i in range(n)]


def odd_rows():
    rows = random_rows(330)
    rows += [(400 + i, None, 1) for i in range(3)] + [(410, [1.0] * 31 + [NAN], 1), (411, [INF] * 32, 2), (412, [-INF] * 32, 2), (413, [None] + [1.0] * 31, 3)]
    rows += [(450, [0.5] * 32, None), (451, rows[7][1], None), (None, rows[50][1], 1), (None, rows[51][1], 0)]
    rows += [(100, rows[100][1], 1), (100, rows[100][1], 1), (100, rows[3][1], 0), (150, [0.0] * 32, 2), (460, [0.0] * 32, 2)]
    rows += [(470, rows[0][1][:20], 1), (471, [], 0), (500, rows[200][1], rows[200][2]), (550, [-x for x in rows[0][1]], 3), (-50, rows[9][1], 1), (-7, rows[8][1], 2)]
    return rows


@pytest.fixture()
def vectors_of(spark):
    def make(rows, parts=3):
        return spark.createDataFrame(rows, VECTORS).repartition(parts)

    return make


def coded(encoded):
    found = active_lloyd.label_errors(encoded, "label")
    return sorted((tuple(r) for r in found.select("row.vec_id", F.lower(F.hex("code")), "error", "label_error").collect()), key=str)


@pytest.mark.parametrize("parts", [1, 4])
def test_codes_match_full_scans_on_odd_vectors(vectors_of, parts):
    rows = odd_rows()
    encoded = active_lloyd.encode(vectors_of(rows, parts).withColumn("code", F.lit("clash")).withColumn("error", F.lit(1)))
    want, books = brute_codes(rows)
    assert encoded.books.tolist() == books
    assert coded(encoded) == want
    assert "code" in encoded.rows.select("row.*").columns


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_codes_after_other_numbers_of_rounds(vectors_of, rounds):
    rows = random_rows(200, 16)
    encoded = active_lloyd.encode(vectors_of(rows), parts=4, entries=8, rounds=rounds)
    want, books = brute_codes(rows, 4, 8, rounds)
    assert (coded(encoded), encoded.books.tolist()) == (want, books)


def test_codes_of_few_and_no_rows(vectors_of):
    few = random_rows(5)
    encoded = active_lloyd.encode(vectors_of(few))
    assert [r[2] for r in coded(encoded)] == [0] * 5 and encoded.books.shape == (16, 5, 2)
    none = active_lloyd.encode(vectors_of([(1, None, 1), (2, [NAN], 1)]))
    assert coded(none) == [] and none.books.size == 0
    assert coded(active_lloyd.encode(vectors_of([]))) == []


def test_active_entries_equal_a_full_scan():
    """Ties to the lower index, fixed and moved entries, duplicated entries."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        x = rng.integers(-3, 4, (200, 2)).astype(float)
        book = rng.integers(-3, 4, (12, 2)).astype(float)
        entry, far = active_lloyd.nearest(x, book)
        moved = rng.random(12) < 0.3
        after = book.copy()
        after[moved] += rng.integers(-1, 2, (moved.sum(), 2))
        got = active_lloyd.reassign(x, entry, far, after, (after != book).any(1))
        for a, b in zip(got, active_lloyd.nearest(x, after), strict=True):
            assert (a == b).all()


def test_fixed_parts_meet_moved_entries_only(monkeypatch):
    """Parts whose entry stayed are compared with the moved entries, the others with all."""
    seen = []
    plain = active_lloyd.nearest
    x = np.array([[0.0], [10.0], [20.0]])
    book = np.array([[0.0], [10.0], [20.0]])
    entry, far = plain(x, book)
    monkeypatch.setattr(active_lloyd, "nearest", lambda y, b: (seen.append((len(y), len(b))), plain(y, b))[1])
    active_lloyd.reassign(x, entry, far, np.array([[0.0], [10.0], [21.0]]), np.array([False, False, True]))
    assert seen == [(1, 3), (2, 1)]


def test_decoded_vectors_have_the_stated_error(vectors_of):
    rows = random_rows(100)
    encoded = active_lloyd.encode(vectors_of(rows))
    for r in encoded.rows.select("row.vec_id", "code", "error").collect():
        v = np.array(scaled(rows[r.vec_id][1], 32))
        assert int(((active_lloyd.decode(r.code, encoded.books, 1) - v) ** 2).sum()) == r.error


def test_op12_checksum(spark):
    found = queries.op12_active_lloyd(spark, "/root/testdata/sf0.001").select("codebooks_sha256").distinct().collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    flat = [x for part in brute_codes(rows)[1] for e in part for x in e]
    assert [r[0] for r in found] == [hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()]


def mined(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def moved():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize(("fragment_rows", "block_anchors"), [(4096, 16_384), (16, 3)])
def test_negatives_match_brute_force_on_odd_vectors(vectors_of, fragment_rows, block_anchors):
    rows = odd_rows()
    df = vectors_of(rows).withColumn("rank", F.lit(1)).withColumn("anchor_id", F.lit("clash"))
    got = mined(bond_negatives.mine(df, label=moved(), fragment_rows=fragment_rows, block_anchors=block_anchors))
    want = brute_negatives(rows)
    assert got == want and len(want) > 20


def test_negatives_of_close_labels(vectors_of):
    """Labels that overlap: windows full of ties and near-equal scores."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 16) / 4], int(rng.integers(0, 3))) for i in range(400)]
    got = mined(bond_negatives.mine(vectors_of(rows, 5), label=moved(), every=10, fragment_rows=64))
    assert got == brute_negatives(rows, 10) and len(got) > 300


def test_negatives_of_empty_tables_and_one_label(vectors_of):
    assert mined(bond_negatives.mine(vectors_of([]))) == []
    assert mined(bond_negatives.mine(vectors_of([(50, None, 1), (100, [1.0], None)]))) == []
    assert mined(bond_negatives.mine(vectors_of([(i, [1.0, 2.0], 1) for i in range(60)]))) == []
    assert mined(bond_negatives.mine(vectors_of([(1, [1.0], 1), (2, [1.0], 2)]))) == []


def test_bounds_read_few_dimensions_of_hopeless_rows():
    """Rows far from the anchor leave the bitmap at the first look."""
    rng = np.random.default_rng(1)
    v = rng.integers(-5, 6, (1000, 64))
    v[:, 3] = np.where(np.arange(1000) < 5, 4000, -4000)
    q = rng.integers(-5, 6, 64)
    q[3] = 500
    f = bond_negatives.Fragment(0, np.arange(1000), np.zeros(1000, np.int64), v.min(0), v.max(0), v.T)
    order = np.argsort(-np.abs(q), kind="stable")
    block = bond_negatives.Block(np.zeros(1), np.zeros(1), np.zeros(1), np.zeros(1), q[None], order[None])
    low, high = bond_negatives._remaining(block, f)
    looked = []

    def wanted(lower, upper):
        looked.append(len(lower))
        return upper >= 1_000_000

    rows, score = bond_negatives._scan(v.T.astype(float), np.arange(1000), q.astype(float), order, low[0], high[0], wanted)
    assert looked[0] == 1000 and set(looked[1:]) == {5}
    assert rows.tolist() == list(range(5)) and score.tolist() == (v[:5] @ q).tolist()
