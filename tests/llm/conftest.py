import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

#: every awkward case in one table: nulls, empty, blanks, repeated rows, markup, other scripts
AWKWARD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n\x0b\f\r ", "en", None, 7), (4, "word", "en", "b", 4),
    (5, "a b c a b c a b c", "en", "b", 17), (5, "a b c a b c a b c", "en", "b", 17), (6, "#*$ %& |<> ##", "de", "a", 13),
    (7, "x\ny\nx\n\nx \n \nx", None, None, 14), (8, "Straße élan \U0001f600 日本語 <|endoftext|>  two   blanks nb", "de", "b", 40),
    (None, "no id here", "fr", "c", 10), (9, "The\x1cQuick\x00Brown  FOX's it'll 12345 " * 3, "en", "c", 90),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs_small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
