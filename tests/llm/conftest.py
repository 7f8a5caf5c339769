import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def docs_of(spark):
    """A documents table of (id, text[, lang, source]) rows, on several partitions."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def mid(spark):
    """(documents, benchmark, labels) of the sf0.01 tables, and the documents as a list."""
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    rows = [(r.doc_id, r.text) for r in read("documents").select("doc_id", "text").collect()]
    return read("documents"), read("benchmark"), read("labels"), rows
