import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that operators use inside, as extra columns
                     T.StructField("payload", T.StringType()), T.StructField("id", T.LongType()), T.StructField("row", T.StringType()),
                     T.StructField("digest", T.StringType()), T.StructField("h1", T.StringType()), T.StructField("size", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns, over several partitions."""

    def make(pairs, partitions=3):
        rows = [(i, t, None, "s", len(t) if t else None, "p", 7, "r", "d", "h", 1) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


ODD = [
    (1, "One short text."), (2, None), (3, ""), (None, "One short text."), (None, None), (4, "   \n\n  \n"), (5, "One short text."),
    (5, "One short text."), (6, "ONE short text."), (7, "É is not é"), (8, "é is not é"), (9, "word " * 30000), (10, "x" * 100000), (11, "word " * 30000),
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, ties and repeated rows."""
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
