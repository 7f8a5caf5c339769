"""Boosted personal data: every document's candidates are learned from, and splits keep the features apart."""

from pyspark.sql import functions as F

from perkflow.llm import pii_boosting


def _cards(n):
    """Texts with a valid, a failing and a run-together card number."""
    good, bad = "4111111111111111", "4111111111111112"
    return [f"card {good} or {bad} of {i}" if i % 2 else f"card {good} 99999 {i}" for i in range(n)]


def test_documents_outside_any_sample_are_learned_from(spark):
    """Of 100,000 documents only those of a large hash hold candidates; a hashed sample of 50,000 has none of them."""
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(pii_boosting.SEED)), F.lit(1 << 30))
    ids = spark.range(100_000).select(F.col("id").alias("doc_id")).withColumn("late", mark >= (1 << 29) + (1 << 28))
    texts = F.array(*[F.lit(t) for t in _cards(40)])
    text = F.when(F.col("late") & (F.col("doc_id") % 97 == 0), F.element_at(texts, (F.col("doc_id") % 40 + 1).cast("int"))).otherwise("none")
    docs = ids.select("doc_id", text.alias("text"))
    model = pii_boosting.fit(docs, "doc_id", "text")
    assert len(model.trees) == pii_boosting.TREES and 2 in model.thresholds


def test_training_rows_count_every_candidate(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(_cards(30))] + [(None, "4111111111111111"), (7, None), (8, "")])
    rows = pii_boosting.training_rows(docs, "doc_id", "text")
    every = docs.select(F.explode(pii_boosting.candidates(F.col("text"))).alias("s")).where("s.generator != 9")
    good = every.where(pii_boosting.valid(F.col("s"))).count()
    got = rows.agg(F.count("*").alias("forms"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good")).first()
    assert got.n == every.count() and got.good == good and got.forms < got.n


def test_steps_keep_the_side_of_every_split(spark):
    values = [-1.0, 0.0, 1.0, 2.0, 3.0, 9.0, 24.0, 25.0, 28.0, 29.0, 100.0, 256.0, 257.0, 512.0, 1e6]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for i in range(pii_boosting.FEATURES):
        steps = [step for j, step in pii_boosting.SPLITS if j == i]
        fits = [v for v in values if len(steps) > 1 or v in (0.0, 1.0)]
        for r in rows.select("v", pii_boosting.stepped(F.col("v"), i).alias("s")).collect():
            assert r.v not in fits or [r.s <= step for step in steps] == [r.v <= step for step in steps]


def test_printed_trees_score_as_the_fitted_ones(spark):
    tree = ["If (feature 1 in {1.0})", " Predict: -1.0", "Else (feature 1 not in {1.0})", " If (feature 3 in {0.0})", "  Predict: 0.5", " Else (feature 3 not in {0.0})", "  Predict: 2.0"]
    split = dict(enumerate(pii_boosting.SPLITS))
    assert split[1] == (0, 1) and split[3] == (1, 0)
    f = lambda kind, base: F.array(F.lit(kind), F.lit(base), *[F.lit(0.0)] * 14)
    cases = [(2.0, 0.0, -1.0), (1.0, 0.0, 0.5), (0.0, 1.0, 2.0)]
    got = spark.range(1).select(*[pii_boosting._tree(tree, 0, f(a, b))[0].alias(f"c{i}") for i, (a, b, _) in enumerate(cases)]).first()
    assert list(got) == [c for _, _, c in cases]
