"""Queries and operators against brute force, on odd rows and on the sf0.01 documents."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perkflow.llm import (
    decontamination_suffix, mixing, outliers_mcd, pii_boosting, queries, simhash_bktree, substring_superkmers, token_shards,
)
from tests.llm import brute
from tests.llm.odd import FOUR, LIKE_KILO, ODD, REPEATS

SF = "/root/testdata/sf0.01"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def wanted(values):
    return sorted(values, key=str)


@pytest.fixture(scope="module")
def bench():
    return [(1, "a b c d e f g h i j k l m n o p"), (2, "one"), (3, None), (4, ""), (5, "One, two; three"), (None, "漢字"), (11, "tie tie"), (12, LIKE_KILO), (13, FOUR)]


def test_op4_matches_brute_force(spark, mid):
    found = queries.op4_suffix_decontamination(spark, SF)
    want = brute.contamination(mid[3], [tuple(r) for r in mid[1].select("item_id", "text").collect()])
    assert rows(found) == wanted(want)


@pytest.mark.parametrize("block_chars", [16_000_000, 800])
def test_decontamination_odd_rows_and_blocks(spark, docs_of, bench, block_chars):
    items = spark.createDataFrame(bench, "item_id long, text string")
    docs = docs_of(ODD + REPEATS).withColumn("n_words", F.lit(-1)).withColumn("matches", F.lit("x"))
    found = decontamination_suffix.find_contamination(docs, items, block_chars=block_chars)
    got = rows(found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.concat_ws(",", "items"), 256), "contaminated"))
    named = [(i, t) for i, t in bench if i is not None]
    want = brute.contamination(ODD + REPEATS, named)
    hits = {w[:4]: w for w in brute.contamination(ODD + REPEATS, bench)}
    assert len(got) == len(want)
    for g, w in zip(got, wanted(want), strict=True):
        if g[0] != 6:  # row 6 holds the item without an id: it hits, but names nothing
            assert g == w
    assert [g[:4] for g in got if g[0] == 6] == [(6, 5, 1, 0)] and any(k[0] == 6 and k[2] == 1 for k in hits)
    kept = decontamination_suffix.remove_contaminated(docs, items, block_chars=block_chars)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not g[5] for g in got)


def test_decontamination_longest_match_is_verbatim(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(40))
    text = "x y " + " ".join(f"w{i}" for i in range(5, 25)) + " z " + " ".join(f"w{i}" for i in range(13))
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    r = decontamination_suffix.find_contamination(docs_of([(1, text)]), items).first()
    assert [tuple(m) for m in r.matches] == [("7", 2, 5, 20)]
    assert r.spans == [2, 22, 23, 36] and r.n_hit == 33


def test_decontamination_empty_tables(spark, docs_of, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert decontamination_suffix.find_contamination(docs_of([]), items).count() == 0
    assert decontamination_suffix.remove_contaminated(docs_of([(1, "one")]), items.limit(0)).count() == 1


def test_op5_matches_brute_force(spark, mid):
    assert rows(queries.op5_substring_superkmers(spark, SF)) == wanted(brute.repeats(mid[3]))


def test_substring_over_full_bucket_goes_to_several_tasks(spark, docs_of, monkeypatch):
    """A passage shared by 60 documents with different words around it: no one task holds all its strings."""
    shared = " ".join(f"s{i}" for i in range(70))
    docs = docs_of([(i, " ".join(f"a{i}x{j}" for j in range(60)) + f" {shared} " + " ".join(f"b{i}x{j}" for j in range(60))) for i in range(60)])
    seen, write = {}, substring_superkmers.materialise

    def spied(df, name):
        if name == "windows":
            df = write(df.withColumn("task", F.spark_partition_id()), name)
            tasks = df.where("window IS NOT NULL").groupBy("window").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks"))
            seen["tasks"] = max(tasks.where("n > 20").collect(), key=lambda r: r["n"], default={"tasks": 0})["tasks"]
            return df
        return write(df, name)

    monkeypatch.setattr(substring_superkmers, "materialise", spied)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        found = substring_superkmers.remove_repeats(docs, bucket_rows=16).select("row.doc_id", "n_removed").collect()
    finally:
        spark.conf.set(key, before)
    assert dict(found) == {0: 0, **{i: 70 for i in range(1, 60)}}
    assert seen["tasks"] > 1


@pytest.mark.parametrize("bucket_rows", [50_000, 2])
def test_substring_odd_rows_and_large_buckets(docs_of, bucket_rows):
    words = [f"v{i}" for i in range(400)]
    passage = words[100:190]
    own = lambda n: [f"u{n}_{i}" for i in range(60)]
    shared = [(100 + n, " ".join(own(n) + passage[n % 7 :] + own(-n))) for n in range(30)]
    data = ODD + REPEATS + shared + [(90, " ".join(words)), (91, " ".join(words)), (91, " ".join(words[::-1])), (None, " ".join(words))]
    docs = docs_of(data).withColumn("kept", F.lit("clash"))
    found = substring_superkmers.remove_repeats(docs, bucket_rows=bucket_rows)
    got = rows(found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
    assert got == wanted(brute.repeats(data))
    assert sum(g[2] > 0 for g in got) > 25


def test_substring_empty(docs_of):
    assert substring_superkmers.remove_repeats(docs_of([])).count() == 0


def test_op8_matches_brute_force(spark, mid):
    got = {r[0]: (r[1], r[2]) for r in queries.op8_simhash_bktree(spark, SF).collect()}
    assert got == brute.components(mid[3])


def test_simhash_odd_rows(docs_of):
    docs = docs_of(ODD).withColumn("fp", F.lit("clash"))
    got = {r["doc_id"]: (f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in simhash_bktree.near_duplicates(docs).collect()}
    assert got == brute.components(ODD)
    again = simhash_bktree.near_duplicates(docs_of(REPEATS)).collect()
    assert len(again) == len(REPEATS)
    by = {r["component_id"] for r in again if r["doc_id"] is None}
    assert None in by
    assert simhash_bktree.near_duplicates(docs_of([])).count() == 0


def test_simhash_keeps_one_per_group(docs_of):
    text = " ".join(f"w{i}" for i in range(300))
    data = [(5, text), (3, text), (3, text), (9, text + " more"), (1, "something else entirely, not alike"), *REPEATS]
    docs = docs_of(data)
    kept = simhash_bktree.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    comp = simhash_bktree.near_duplicates(docs).collect()
    assert len(got) == len({(r["component_id"], r["fp"] if r["component_id"] is None else 0) for r in comp})
    assert got.count(3) == 1 and 5 not in got and 1 in got


def test_simhash_kept_columns_that_clash(docs_of):
    docs = docs_of(ODD).withColumn("fp", F.lit("mine")).withColumn("component_id", F.lit("too"))
    got = simhash_bktree.near_duplicates(docs, keep=["doc_id", "fp", "component_id"])
    assert got.columns == ["doc_id", "fp_kept", "component_id_kept", "fp", "component_id"]
    assert {(r[1], r[2]) for r in got.collect()} == {("mine", "too")}
    assert {r[0]: (f"{r[3] % 2**64:016x}", r[4]) for r in got.collect()} == brute.components(ODD)


def test_near_links_of_a_tight_shard_stream_past_its_trees(spark):
    """3,000 fingerprints within 8 bits of one another, in trees of about 100 and batches of 64 rows."""
    rng = np.random.default_rng(8)
    flips = (np.uint64(1) << rng.integers(0, 64, (3000, 4)).astype(np.uint64)).astype(np.uint64)
    values = np.unique(np.bitwise_xor.reduce(flips, axis=1))
    classes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        links = simhash_bktree.near_links(classes, shard_rows=100).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = simhash_bktree.join_labels(np.arange(len(values)), *np.nonzero(close))
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    a, b = (np.array([at[r[k]] for r in links], int) for k in (0, 1))
    assert (simhash_bktree.join_labels(np.arange(len(values)), a, b) == want).all()


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_near_links_span_components(spark, blocks):
    rng = np.random.default_rng(blocks)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = base[:40] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(7) << rng.integers(0, 60, 40).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, near[:20] ^ np.uint64(0x8000000000000001)]))
    classes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash_bktree.near_links(classes, blocks=blocks, shard_rows=3).collect()
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = simhash_bktree.join_labels(np.arange(len(values)), *np.nonzero(close))
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    a, b = (np.array([at[r[k]] for r in links], int) for k in (0, 1))
    assert (want[a] == want[b]).all()
    assert (simhash_bktree.join_labels(np.arange(len(values)), a, b) == want).all()


def test_op6_matches_the_library(spark, mid):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for d, text in sorted(mid[3]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(queries.op6_wavelet_shards(spark, SF)) == wanted(want)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_shards_odd_rows(spark, docs_of, scratch, name):
    path = public_tokenizers.path(name)
    t = Tokenizer.from_file(path)
    data = [r for r in ODD if r[0] not in (8, 14)]
    token_shards.write_shards(docs_of(data + REPEATS), scratch, path, end_id=2, shard_tokens=500)
    got = sorted(token_shards.read_documents(spark, scratch).collect(), key=lambda r: r["start"])
    ids = {d: [*t.encode(x or "", add_special_tokens=False).ids, 2] for d, x in data}
    assert [r["doc_id"] for r in got] == [None] * 3 + sorted([d for d, _ in data] + [20] * 3)
    place = 0
    for r in got:
        assert r["start"] == place
        place += r["n_tokens"]
        if r["doc_id"] in ids:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["doc_id"]]
    flat = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got])
    tokens = [2, int(flat[40]), 1, 10**9]
    counted = dict(token_shards.count_tokens(spark, scratch, tokens).collect())
    assert counted == {k: int((flat == k).sum()) for k in tokens}
    where = sorted(r["position"] for r in token_shards.locate_token(spark, scratch, int(flat[40])).collect())
    assert where == np.flatnonzero(flat == flat[40]).tolist()


def test_encoder_equals_the_library_on_any_text():
    """Random mixes of characters that a shortcut could get wrong."""
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = token_shards.Encoder(t, 2, token_shards.splits_words(t))
    assert enc.splits
    rng = np.random.default_rng(6)
    pool = [*"abcXYZ  \n\t\r'’\"123.,-!?#<|>éÉèß×÷ŸÿñÀÞªµºœſİıΣσςкЖ漢字😀", "\u0301", "\u00a0", "\u2003", "\x00", "\x1f",
            "<|endoftext|>", "<|startoftext|>", "don't", "'S", "'ll", "Å", "ﬁ", "ǅ", "<|"]
    for _ in range(60):
        texts = ["".join(rng.choice(pool, rng.integers(0, 50))) for _ in range(20)]
        ids, sizes = enc.encode(texts)
        want = [[*e.ids, 2] for e in t.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == sum(want, [])


def test_token_shards_empty(spark, docs_of, scratch):
    token_shards.write_shards(docs_of([]), scratch, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    assert token_shards.read_documents(spark, scratch).count() == 0


def test_wavelet_matrix_round_trip():
    rng = np.random.default_rng(5)
    for n, bits in ((0, 4), (1, 1), (70_000, 17), (200_000, 9)):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        m = token_shards.WaveletMatrix(token_shards.WaveletMatrix.build(ids, bits, [1], np.array([n])))
        assert (m.decode() == ids).all()
        for i in (0, n // 2, n - 1) if n else ():
            assert m.access(i) == ids[i]
            assert m.count(int(ids[i])) == (ids == ids[i]).sum()
            assert (m.locate(int(ids[i])) == np.flatnonzero(ids == ids[i])).all()


def test_op1_base_matches_brute_force(spark, mid):
    got = {r[0]: tuple(r)[:6] for r in queries.op1_pii_boosting(spark, SF).collect()}
    assert got == {d: brute.personal_row(d, t) for d, t in mid[3]}


PII_TEXTS = [
    "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "é@b.c é1.2.3.4", "@@@", "a@b", "1.2.3.256 000255.1.1.1",
    "+1 (843) 555-7672 170.106.47.218", "9" * 16 + " 4111111111111111", "+1 " * 300, "1 " * 400, "😀 x@y.z 😀",
    "(843) 555-7672", "joe [at] mail [dot] com",
]


def test_pii_odd_rows(docs_of):
    data = ODD + REPEATS + [(100 + i, t) for i, t in enumerate(PII_TEXTS)]
    docs = docs_of(data).withColumn("base", F.lit(1)).withColumn("all", F.lit(2))
    got = pii_boosting.find_spans(docs).select("row.doc_id", "base").collect()
    assert rows(pii_boosting.find_spans(docs).select("row.doc_id", pii_boosting.span_text(F.col("base")))) == wanted(
        (d, ",".join(f"{brute.PII[k][0]}:{a}:{b}" for a, k, b in brute.personal(t))) for d, t in data
    )
    assert len(got) == len(data)
    assert pii_boosting.find_spans(docs_of([])).count() == 0


def test_pii_trees_add_numbers_that_base_rules_lose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = pii_boosting.find_spans(docs).where(F.size("added") > 0)
    texts = {
        r["row"]["text"][s["start"] : s["end"]]
        for r in found.collect()
        for s in r["added"]
    }
    assert texts and all(brute.luhn(t) if t.isdigit() else t.startswith("+") for t in texts)


def test_pii_redaction(docs_of):
    docs = docs_of([(1, "mail joe@x.org or +1 (843) 555-7672."), (2, None), (3, "nothing")])
    assert dict(pii_boosting.redact(docs).select("doc_id", "text").collect()) == {1: "mail [email] or [phone].", 2: None, 3: "nothing"}


def test_op7_base_matches_brute_force(spark, mid):
    got = {r[0]: tuple(r)[1:7] for r in queries.op7_mcd_outliers(spark, SF).collect()}
    assert got == {d: brute.quality_counts(t) for d, t in mid[3]}


def test_op7_keeps_good_and_rejects_junk(spark, mid):
    got = queries.op7_mcd_outliers(spark, SF).join(mid[2], "doc_id")
    good = got.where("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    junk = got.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good == 1.0 and junk < 0.2


def test_outliers_each_repeat_statistic_rejects_alone(docs_of):
    """A page of duplicate menu lines, and a long one with a quarter of its words repeated, among ordinary ones of their group."""
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in ("man", "tor", "lis", "pel") for b in ("a", "e", "io", "u") for c in ("n", "rt", "s", "lm")]
    some = lambda n: " ".join(rng.choices(words, k=n))
    data = [(i, "\n".join(some(12) for _ in range(20))) for i in range(150)]
    menu = [some(1) for _ in range(5)]
    data.append((500, "\n".join([some(12) for _ in range(8)] + [rng.choice(menu) for _ in range(120)])))
    head = some(80)
    data.append((501, "\n".join([head + " " + some(250), head + " " + some(230)])))
    got = {r["k0"]: r for r in outliers_mcd.judge(docs_of(data), ["doc_id"]).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert got[500]["n_dup_lines"] > 100 and got[500]["n_repeat_words"] * 10 < got[500]["n_words"]
    assert got[501]["n_dup_lines"] == 0 and got[501]["n_repeat_words"] >= 160
    assert sorted(d for d, r in got.items() if not r["kept"]) == [500, 501]


def test_outliers_odd_rows(docs_of):
    data = ODD + REPEATS + [(30, "x y\nx y\n x y\n\n \nx y", None, None), (31, "### $$$ " * 10, "fr", None)]
    docs = docs_of(data).withColumn("n_words", F.lit("clash")).withColumn("g", F.lit(1))
    got = outliers_mcd.judge(docs, ["doc_id"])
    assert rows(got.select("k0", *outliers_mcd.COUNTS[:5], "base_failed")) == wanted((r[0], *brute.quality_counts(r[1])) for r in data)
    assert got.where("kept AND base_failed OR kept IS NULL").count() == 0
    assert outliers_mcd.judge(docs_of([]), ["doc_id"]).count() == 0


def test_op2_draws_near_targets_and_is_repeatable(spark, mid):
    one, two = rows(queries.op2_mixing(spark, SF)), rows(queries.op2_mixing(spark, SF))
    assert one == two
    assert all(0 <= r[4] <= 3 * r[1] for r in one)
    total = sum(r[1] for r in one)
    targets = {r[2:4] for r in one}
    assert abs(sum(t for _, t in targets) - total) < 1e-6 * total
    assert abs(sum(r[4] for r in one) - total) < 0.1 * total


def test_mixing_odd_rows(docs_of):
    data = [(i, "w " * (i + 1), "en", s) for i, s in enumerate(["a", "b", None, "a", "c", "d", "e", None])]
    data += [(50, None, "en", "z"), (51, "", "en", "z"), (None, "x", "en", "a"), (0, "w ", "en", "a")]
    docs = docs_of(data).withColumn("size", F.lit("clash")).withColumn("copies", F.lit(7))
    planned = mixing.plan_mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", F.col("copies")).collect()
    assert len(planned) == len(data)
    want = brute.targets([(d[3], brute.size(d[1])) for d in data])
    assert all(abs(r["target"] - want[r["source"]]) < 1e-9 * max(1, r["target"]) for r in planned)
    assert all(0 <= r["copies"] <= 3 for r in planned) and all(r["copies"] == 0 for r in planned if r["source"] == "z")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in planned)
    assert mixing.mix(docs_of([])).count() == 0


def test_pii_in_a_log_of_many_addresses(docs_of):
    """Thousands of spans in one text, some of them invalid."""
    text = "\n".join(f"10.{i % 256}.{i // 256}.{i % 300} user{i}@host{i % 7}.example.com {4000000000000000 + i}" for i in range(6000))
    got = pii_boosting.find_spans(docs_of([(1, text), (2, "none")])).where("row.doc_id = 1").select("base").first()[0]
    assert [(s["start"], s["kind"], s["end"]) for s in got] == brute.personal(text)
