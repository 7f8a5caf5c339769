"""Learned operators: held-out accuracy, determinism, odd rows; the pipeline stage by stage."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from perkflow.llm import importance_resampling, license_scan, mixing, queries, toxicity_chain
from perkflow.llm.components import connected_components
from perkflow.llm.text import ngram_ranks, whole_groups
from tests.llm import brute
from tests.llm.odd import ODD, REPEATS

SF = "/root/testdata/sf0.01"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def labels_of(spark, data):
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


def test_op3_separates_good_from_junk(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op3_importance_resampling(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    kept = dict(got.groupBy("quality").agg(F.avg(F.col("selected").cast("int"))).collect())
    assert kept[1] > 0.99 and kept[0] < 0.1


def test_resampling_is_top_k_of_the_keys(spark, mid):
    docs, _, labels, _ = mid
    one = rows(queries.op3_importance_resampling(spark, SF))
    assert one == rows(queries.op3_importance_resampling(spark, SF))
    cut = min(r[2] for r in one if r[3])
    assert all(r[3] == (r[2] >= cut) for r in one)
    top = importance_resampling.select_quality(docs, labels, k=137)
    keys = sorted((r["key"] for r in top.select("key").collect()), reverse=True)
    assert top.where("selected").agg(F.min("key"), F.count("*")).first() == (keys[136], 137)


def test_resampling_log_ratio_against_plain_counts(spark, docs_of):
    data = [(1, "abcdef abcdef"), (2, "abcdef"), (3, "qqqq qqqq"), (4, ""), (5, None)]
    labels = labels_of(spark, [(i, 1, 0) for i in (1, 2)])
    scored = importance_resampling.score(docs_of(data), importance_resampling.fit(docs_of(data), labels)).collect()
    got = {r["row"]["doc_id"]: r["log_ratio"] for r in scored}
    held = {r["row"]["doc_id"] for r in scored if r["held_out"]}
    raw, target = np.ones(importance_resampling.BUCKETS), np.ones(importance_resampling.BUCKETS)
    grams = {d: np.concatenate([b for b, _ in importance_resampling.ngram_buckets(pa.array([t or ""]))]) for d, t in data}
    for d, g in grams.items():
        np.add.at(raw, g, 1)
        if d in (1, 2) and d not in held:
            np.add.at(target, g, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum()) if held != {1, 2} else np.zeros_like(raw)
    assert all(math.isclose(got[d], ratio[g].sum(), abs_tol=1e-5) for d, g in grams.items())


def test_resampling_odd_rows(spark, docs_of):
    docs = docs_of(ODD + REPEATS).withColumn("key", F.lit("clash")).withColumn("log_ratio", F.lit(0))
    labels = labels_of(spark, [(1, 1, 0), (4, 1, 0), (4, 1, 1), (7, 0, 0), (None, 1, 0), (9, None, None), (20, 1, 0)])
    kept = importance_resampling.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == importance_resampling.select_quality(docs, labels).where("selected").count() > 0
    assert importance_resampling.keep_selected(docs, labels.limit(0)).count() == len(ODD + REPEATS)
    assert importance_resampling.keep_selected(docs_of([]), labels).count() == 0


@pytest.mark.parametrize("k", [0, 1, 3, 6, 9])
def test_kth_largest(spark, k):
    values = [5.0, -2.0, 5.0, 7.5, 1e300, -1e-9]
    got = importance_resampling.kth_largest(spark.createDataFrame([(v,) for v in values], "v double"), "v", k)
    want = math.inf if k < 1 else sorted(values, reverse=True)[k - 1] if k <= len(values) else -math.inf
    assert got == want


def test_op10_finds_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op10_toxicity_chain(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    flagged = dict(got.groupBy("toxic").agg(F.avg(F.col("is_toxic").cast("int"))).collect())
    assert flagged[1] > 0.9 and flagged[0] < 0.005


def test_toxicity_held_out(spark):
    """Fitted without a third of the labels, judged on that third."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    got = toxicity_chain.classify(docs, labels.where(~third)).select(F.col("row.doc_id").alias("doc_id"), "is_toxic")
    judged = got.join(labels.where(third), "doc_id")
    flagged = dict(judged.groupBy("toxic").agg(F.avg(F.col("is_toxic").cast("int"))).collect())
    assert flagged[1] > 0.88 and flagged[0] < 0.01


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    first = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(float)
    second = (first + 0.1 * rng.normal(size=600) > 0.5).astype(float)
    weights, out = toxicity_chain.fit_chain(x, np.stack([first, second], 1), np.arange(600) % 5)
    assert [len(w) for w in weights] == [4, 5] and weights[1][3] > 0
    chain = toxicity_chain.Chain(np.zeros(0, int), np.ones(3), weights, 0.5)
    assert ((chain.predict(x)[:, 1] > 0.5) == second).mean() > 0.8
    assert ((out > 0.5) == np.stack([first, second], 1)).mean() > 0.8


def test_toxicity_odd_rows(spark, docs_of):
    bad = [(40 + i, f"you stupid trash idiot number {i}") for i in range(8)]
    good = [(60 + i, f"the weather in town {i} is mild") for i in range(8)]
    docs = docs_of(ODD + REPEATS + bad + good).withColumn("p_toxic", F.lit("clash"))
    labels = labels_of(spark, [(d, 1, 1) for d, _ in bad] + [(d, 1, 0) for d, _ in good] + [(None, 1, 1), (1, 0, None), (60, 0, 1), (60, 0, 0)])
    got = toxicity_chain.classify(docs, labels)
    assert got.count() == docs.count() and got.where("p_toxic IS NULL OR is_toxic IS NULL").count() == 0
    flagged = {r["row"]["doc_id"] for r in got.where("is_toxic").collect()}
    assert {d for d, _ in bad} <= flagged
    assert toxicity_chain.classify(docs, labels.limit(0)).where("is_toxic").count() == 0
    assert toxicity_chain.classify(docs_of([]), labels).count() == 0


def contained(text, templates=license_scan.TEMPLATES):
    """Names by exact containment over all windows, without signatures."""
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    doc, names = grams(cut(text)), set()
    sets = [(n, set(grams(cut(t)))) for n, t in templates]
    for size in {1 << (len(s) - 1).bit_length() for _, s in sets if s}:
        for k in range(len(doc) // size + 1):
            window = set(doc[k * size : (k + 2) * size])
            shares = [(len(s & window) / len(s), n) for n, s in sets if s and 1 << (len(s) - 1).bit_length() == size]
            best = max(c for c, _ in shares)
            names |= {n for c, n in shares if c == best >= 0.8}
    return sorted(names)


def test_license_scan_matches_exact_containment(docs_of):
    words = [f"w{i}" for i in range(300)]
    data = list(ODD + REPEATS)
    for i, (_, t) in enumerate(license_scan.TEMPLATES):
        parts = t.split(" ")
        data.append((200 + i, " ".join(words[: 13 * i]) + " " + t.upper() + " " + " ".join(words)))
        data.append((300 + i, " ".join(words[: 7 * i]) + " " + " ".join(parts[: -max(1, len(parts) // 8)]) + " " + " ".join(words)))
    docs = docs_of(data).withColumn("matches", F.lit("clash"))
    got = rows(license_scan.scan(docs).select("row.doc_id", "licenses"))
    assert got == sorted(((d, contained(t)) for d, t in data), key=str)
    assert all(g[1] for g in got if g[0] is not None and 200 <= g[0] < 300)


def test_license_scan_keeps_every_notice_of_a_window(docs_of):
    """An exact notice doesn't hide an edited one beside it; a notice that a better one explains stays out."""
    by = {n: t for n, t in license_scan.TEMPLATES}
    mpl, gpl3 = by["MPL-2.0"].replace("distributed", "shipped"), license_scan.TEMPLATES[12][1]
    edited = gpl3.replace("redistribute", "share")
    data = [
        (1, by["MIT"] + " " + mpl), (2, mpl + " " + by["MIT"]), (3, mpl), (4, by["GPL-2.0"]), (5, gpl3), (6, edited),
        (7, by["LGPL-2.1"]), (8, by["GPL-2.0"] + " " + edited),
    ]
    got = dict(license_scan.scan(docs_of(data)).select("row.doc_id", "licenses").collect())
    assert got == {
        1: ["MIT", "MPL-2.0"], 2: ["MIT", "MPL-2.0"], 3: ["MPL-2.0"], 4: ["GPL-2.0"], 5: ["GPL-3.0"], 6: ["GPL-3.0"], 7: ["LGPL-2.1"],
        8: ["GPL-2.0", "GPL-3.0"],
    }


def test_license_scan_empty(docs_of):
    assert license_scan.scan(docs_of([])).count() == 0
    assert license_scan.scan(docs_of([(1, "All rights reserved")]), templates=(("short", "All rights reserved."),)).first()["licenses"] == []


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 200), (300, 301), (301, 302), (300, 301), (None, 5), (6, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(connected_components(df, "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, 200: 0, 300: 300, 301: 300, 302: 300}
    assert connected_components(df.limit(0), "a", "b").count() == 0


def test_ngram_ranks_are_exact():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 13, 50):
        ids = rng.integers(0, 2, 400)
        rows_ = np.array([0, 150, 150, 153, 400])
        stop = np.repeat(rows_[1:], np.diff(rows_))
        ranks, order = ngram_ranks(np.unique(ids, return_inverse=True)[1], stop, k)
        grams = [tuple(ids[i : min(i + k, stop[i])]) for i in range(400)]
        assert all((ranks[i] == ranks[j]) == (grams[i] == grams[j]) for i in range(0, 400, 7) for j in range(400))
        assert [grams[i] for i in order] == sorted(grams)


def test_whole_groups_never_cut_a_group():
    keys = [1] * 3 + [2] * 10 + [3] + [4] * 2 + [5] * 30 + [6]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 4], "v": list(range(i, min(i + 4, len(keys))))}) for i in range(0, len(keys), 4)]
    for most in (None, 5):
        seen, parts = [], list(whole_groups(iter(batches), ["k"], 3, most))
        for table, whole in parts:
            seen += table.column("v").to_pylist()
            ks = set(table.column("k").to_pylist())
            if whole:
                assert all(keys.count(k) == table.column("k").to_pylist().count(k) for k in ks)
            else:
                assert len(ks) == 1 and keys.count(ks.pop()) > 5
        assert seen == list(range(len(keys)))


def test_pipeline_against_brute_force(spark, mid):
    docs, bench, labels, data = mid
    text = dict(data)
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert kept.columns == docs.columns
    selected = {r["doc_id"] for r in queries.op3_importance_resampling(spark, SF).where("selected").collect()}
    left = [(d, text[d]) for d in sorted(selected)]
    comp = brute.components(left)
    left = [(d, t) for d, t in left if comp[d][1] == d]
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    dirty = {r[0] for r in brute.contamination(left, items) if r[5]}
    left = [(d, t) for d, t in left if d not in dirty]
    planned = mixing.plan_mix(docs.where(F.col("doc_id").isin([d for d, _ in left]))).select("row.doc_id", "copies").collect()
    copies = dict(planned)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for d, x in left:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        for _ in range(copies[d]):
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert rows(corpus_pipeline.run(spark, SF)) == sorted(want, key=str)
    assert dirty and len(comp) > len(left)


def test_stages_keep_columns_and_take_empty_tables(spark, docs_of):
    docs = docs_of(ODD + REPEATS).withColumn("row", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs, SF).count() <= 3 * docs.count()
        assert stage(spark, docs_of([]), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_labelled_rows_hold_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, True), (1, False), (2, False), (9, True), (None, True)], "doc_id long, toxic boolean")
    rows = toxicity_chain.labelled_rows(docs, labels, "doc_id", "text", "toxic", 100)
    assert sorted(map(tuple, rows.select("id", "t", "y").collect())) == [(1, "a", 1), (2, None, 0)]
