import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); columns may be added."""

    def make(rows, **extra):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        schema = T.StructType([*DOC_SCHEMA.fields, *(T.StructField(k, T.StringType()) for k in extra)])
        return spark.createDataFrame([(*r, *extra.values()) for r in full], schema)

    return make


@pytest.fixture(scope="session")
def sample_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def sample_rows(sample_docs):
    return [tuple(r) for r in sample_docs.collect()]
