"""Kneser-Ney models against a plain restatement; predictions on held-out documents and odd rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perkflow.llm import language_kn, queries
from tests.llm.odd import ODD, REPEATS

K = language_kn.ORDER
VOICES = {
    "aa": ["the", "house", "stands", "there", "with", "three", "thin", "feathers"],
    "bb": ["der", "haus", "steht", "dort", "mit", "drei", "ünd", "größe"],
    "cc": ["дом", "стоит", "там", "где", "три", "пера", "лежат"],
}


def plain(text):
    """Letters in lower case, words apart by one space."""
    t = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
    return " ".join(t.split())


def voiced(n, seed=1, words=30):
    rng = np.random.default_rng(seed)
    names = sorted(VOICES)
    return [(i, " ".join(rng.choice(VOICES[names[i % 3]], rng.integers(3, words))), names[i % 3], f"s{i % 2}") for i in range(n)]


class Brute:
    """Interpolated Kneser-Ney by dictionaries, one language."""

    def __init__(self, texts, alphabet):
        self.alphabet = alphabet
        counts = {k: Counter() for k in range(1, K + 1)}
        for t in texts:
            s = " " * (K - 1) + plain(t) + " "
            for i in range(K - 1, len(s)):
                counts[K][s[i - K + 1 : i + 1]] += 1
        for k in range(K - 1, 0, -1):
            for g in counts[k + 1]:
                counts[k][g[1:]] += 1
        self.counts = counts
        self.total, self.kinds = defaultdict(Counter), defaultdict(Counter)
        self.discount = {}
        for k, c in counts.items():
            of = Counter(c.values())
            self.discount[k] = max(0.1, of[1] / (of[1] + 2 * of[2])) if of[1] else 0.5
            for g, n in c.items():
                self.total[k][g[:-1]] += n
                self.kinds[k][g[:-1]] += 1

    def probability(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.alphabet + 1)
        total = self.total[k][gram[:-1]]
        lower = self.probability(gram[1:])
        if not total:
            return lower
        d = self.discount[k]
        return max(self.counts[k][gram] - d, 0) / total + d * self.kinds[k][gram[:-1]] / total * lower

    def bits(self, text):
        s = " " * (K - 1) + plain(text) + " "
        n = len(s) - K + 1
        return -sum(math.log2(self.probability(s[i - K + 1 : i + 1])) for i in range(K - 1, len(s))) / n, n


def column(texts):
    return pa.array(texts, pa.string())


def test_spelled_texts():
    texts = ["Ab, c!", None, "", "12 ..", "  x", "É\nß漢😀y "]
    s = language_kn.spelled(column(texts))
    got = ["".join(map(chr, s.codes[a:b])) for a, b in zip(s.rows[:-1], s.rows[1:], strict=True)]
    pad = " " * (K - 1)
    assert got == [pad + plain(t) + " " if plain(t) else "" for t in texts]


def test_models_match_plain_kneser_ney(spark, docs_of):
    rows = voiced(90) + [(1000 + i, f"zebra qua{i}ck", "aa") for i in range(5)]
    training = docs_of(rows).select("lang", F.col("text").alias("t"))
    model = language_kn.fit(training)
    alphabet = len({c for _, t, *_ in rows for c in plain(t)} | {" "})
    brute = {x: Brute([r[1] for r in rows if r[2] == x], alphabet) for x in VOICES}
    texts = [r[1] for r in rows[::7]] + ["unseen thistle", "Größe", "漢字", "a", "там feathers", "qq  qq", "der " * 5000]
    bits, size = model.entropies(language_kn.spelled(column(texts)))
    assert model.languages == sorted(VOICES)
    for i, t in enumerate(texts):
        for j, x in enumerate(model.languages):
            want, n = brute[x].bits(t)
            assert n == size[i] and bits[i, j] == pytest.approx(want, rel=1e-4)


def test_probabilities_sum_to_one(spark, docs_of):
    rows = voiced(60)
    model = language_kn.fit(docs_of(rows).select("lang", F.col("text").alias("t")))
    chars = sorted({c for _, t, *_ in rows for c in plain(t)} | {" "})
    for context in ("    ", "hous", "zzzz", "е ст"):
        columns = [np.full(len(chars) + 1, ord(c), np.uint64) for c in context] + [np.array([*map(ord, chars), 0x2FFF], np.uint64)]
        assert np.allclose((2.0 ** model.log2(columns, len(chars) + 1)).sum(0), 1, atol=1e-4)


def test_pruned_models_stay_small_and_tell_languages_apart(spark, docs_of):
    rows = voiced(120)
    training = docs_of(rows).select("lang", F.col("text").alias("t"))
    model = language_kn.fit(training, most=60)
    assert sum(len(h.hashes) - 1 for h in model.orders[1:]) <= 60
    bits, _ = model.entropies(language_kn.spelled(column([r[1] for r in rows])))
    assert [model.languages[i] for i in bits.argmin(1)] == [r[2] for r in rows]


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_held_out_documents_and_odd_rows(spark, docs_of):
    rows = [(r[0], r[1], "bb" if r[0] in (7, 8) else "aa") for r in ODD] + [(*r, "aa") for r in REPEATS]
    rows += [(100 + i, *r[1:]) for i, r in enumerate(voiced(240))] + [(900, "the house stands", None), (901, None, "bb"), (902, "", "bb"), (903, "42 7", "dd")]
    docs = docs_of(rows).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(9)).withColumn("t", F.lit(1))
    found = language_kn.identify(docs)
    got = found.select("row.doc_id", "row.lang", "row.lang_pred", "t", "held_out", found["lang_pred"].alias("p"), found["score"].alias("s")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and remainder(r.doc_id) == 2)
        assert (r.p == "und") == (not plain(r.t)) and 0 <= r.s <= 1 and (r.p != "und" or r.s == 0)
        assert r.p in {"aa", "bb", "cc", "und"} and r["lang_pred"] == "clash"
    voices = [r for r in got if r.doc_id is not None and 100 <= r.doc_id < 340]
    assert all(r.p == r.lang for r in voices) and any(r.held_out for r in voices)
    fewer = language_kn.identify(docs, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score").collect()
    assert sorted(map(str, map(tuple, fewer))) == sorted(str((r.doc_id, r.p, r.s)) for r in got)


def test_held_out_labels_and_other_columns_teach_nothing(spark, docs_of):
    """Predictions stay when held-out languages, all sources and the order of rows change."""
    rows = voiced(150)
    other = [(d, t, "zz" if remainder(d) == 2 else x, "elsewhere") for d, t, x, _ in rows][::-1]
    a, b = (language_kn.identify(docs_of(r, p), keep=["doc_id"]).select("row.doc_id", "lang_pred", "score") for r, p in ((rows, 3), (other, 5)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_nothing_to_learn(spark, docs_of):
    assert language_kn.identify(docs_of([])).count() == 0
    found = language_kn.identify(docs_of([(1, "abc", None), (None, "abc", "aa"), (2, None, "aa")]))
    assert [(r.lang_pred, r.score, r.rejected) for r in found.collect()] == [("und", 0.0, True)] * 3
    assert "t" in found.columns


def test_foreign_texts_are_rejected(spark, docs_of):
    rows = voiced(600, words=60) + [(5000 + i, "xyzzy qwq vvv jkjk " * 10, None) for i in range(5)]
    found = language_kn.identify(docs_of(rows), keep=["doc_id"])
    foreign = F.col("row.doc_id") >= 5000
    assert found.where(foreign & F.col("rejected")).count() == 5
    assert found.where(~foreign & F.col("rejected")).count() <= 12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = queries.op11_kneser_ney(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right >= 0.99 * n


def test_pooled_shares_never_fall():
    got = language_kn.monotone(np.array([1.0, 0.0, 2.0, 1.0, 3.0]), np.array([2.0, 2.0, 2.0, 2.0, 3.0]))
    assert got.tolist() == [0.25, 0.25, 0.75, 0.75, 1.0]


def judged(docs, **bound):
    found = language_kn.identify(docs, keep=["doc_id"], **bound)
    return sorted(map(tuple, found.select("row.doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected").collect()), key=str)


@pytest.mark.parametrize("bound", [{"most": 60}, {"cells": 2}])
def test_models_beyond_the_bound_leave_no_gram_out(spark, docs_of, bound):
    """n-grams that don't go to the workers count as they do in whole models; so do unseen ones."""
    rows = voiced(240) + [(None, "the house", "aa"), (7, None, "bb"), (8, "42 !", "cc"), (9, "", "aa"), (9, "qqq der там " * 40_000, None), (9, "漢字 xyz", None)]
    rows += [(5000 + i, f"feathers qua{i}ck дом{i}", "aa") for i in range(40)]
    whole, bounded = judged(docs_of(rows)), judged(docs_of(rows, 5), **bound)
    assert len(whole) == len(bounded) == len(rows)
    for a, b in zip(whole, bounded, strict=True):
        assert a[:3] == b[:3] and a[5] == b[5] and a[3] == pytest.approx(b[3], abs=1e-5)
        assert (a[4] is None) == (b[4] is None) and (a[4] is None or a[4] == pytest.approx(b[4], abs=1e-4))
