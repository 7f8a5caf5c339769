"""The corpus pipeline: documents through the llm operators, one written stage after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared work folder and reread as the next stage's
documents. All but the last return the columns of their input; each works on
every row that its predecessor kept. Nulls, empty texts, repeated rows and
empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perkflow.llm import decontamination_suffix, importance_resampling, mixing, queries, simhash_bktree
from perkflow.llm.components import discard, materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling doesn't select go."""
    return importance_resampling.keep_selected(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_bktree.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go."""
    return decontamination_suffix.remove_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated until the sources have their target weights."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files, answered by place, length and checksum of each document."""
    return queries.token_digests(spark, docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix_sources),
    ("token-id output", token_output),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    docs = queries.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if k:
            discard(before)
    return docs
