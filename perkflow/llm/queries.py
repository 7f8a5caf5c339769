"""Registered queries of the operators, and their SQL where SQL can express them.

Each query applies one operator, with its production parameters, to its whole
table and derives the agreed digest columns from the operator's output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm import (
    active_lloyd, bond_negatives, decontamination_suffix, importance_resampling, language_kn, license_scan, mixing, oracle_sql, outliers_mcd, pii_boosting, simhash_bktree,
    substring_superkmers, token_shards, toxicity_chain,
)
from perkflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii_boosting.find_spans(table(spark, sf_dir, "documents"))
    counts = [pii_boosting.count_kind(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(pii_boosting.KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(pii_boosting.span_text(F.col("base")), 256).alias("base_sha256"),
        pii_boosting.span_text(every).alias("spans"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and words taken of every document."""
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return planned.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", taken)


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log ratio, sampling key and selection of every document."""
    found = importance_resampling.select_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"]
    )
    return found.select(F.col("row.doc_id").alias("doc_id"), "log_ratio", "key", "selected")


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontamination_suffix.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op5_substring_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat 50-word windows of earlier ones."""
    found = substring_superkmers.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    return token_digests(spark, table(spark, sf_dir, "documents"))


def token_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token shards of ``docs`` to a fresh folder of the shared work folder and read them back."""
    path = scratch_path(spark, "token-shards")
    token_shards.write_shards(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = token_shards.read_documents(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    found = outliers_mcd.judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        F.col("k0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"
    )


def op8_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_bktree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("licenses").cast("long").alias("n_licenses"), F.concat_ws(",", "licenses").alias("licenses"),
        F.size(F.array_distinct(F.transform("matches", lambda m: m["template"]))).cast("long").alias("n_templates"),
    )


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of each toxicity category and the verdict for every document."""
    found = toxicity_chain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), *[f"p_{c}" for c in toxicity_chain.NAMES], "is_toxic")


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    found = language_kn.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op12_active_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, the error of its label and the checksum of the codebooks."""
    encoded = active_lloyd.encode(table(spark, sf_dir, "embeddings"))
    sha = hashlib.sha256(",".join(map(str, encoded.books.ravel().tolist())).encode()).hexdigest()
    found = active_lloyd.label_errors(encoded, "label")
    return found.select(
        F.col("row.vec_id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(sha).alias("codebooks_sha256"),
    )


def op13_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; every seventh id's label moves on by one first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return bond_negatives.mine(table(spark, sf_dir, "embeddings"), label=moved)


QUERIES: dict[str, Query] = {
    "op1_pii_boosting": op1_pii_boosting,
    "op2_mixing": op2_mixing,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_suffix_decontamination": op4_suffix_decontamination,
    "op5_substring_superkmers": op5_substring_superkmers,
    "op6_wavelet_shards": op6_wavelet_shards,
    "op7_mcd_outliers": op7_mcd_outliers,
    "op8_simhash_bktree": op8_simhash_bktree,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity_chain": op10_toxicity_chain,
    "op11_kneser_ney": op11_kneser_ney,
    "op12_active_lloyd": op12_active_lloyd,
    "op13_bond_negatives": op13_bond_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": oracle_sql.MIXING,
    "op4_suffix_decontamination": oracle_sql.SUFFIX_DECONTAMINATION,
    "op5_substring_superkmers": oracle_sql.SUBSTRING_DEDUP,
    "op9_license_scan": oracle_sql.license_scan(license_scan.TEMPLATES),
    "op12_active_lloyd": oracle_sql.VECTOR_CODES,
    "op13_bond_negatives": oracle_sql.HARD_NEGATIVES,
}
