import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) rows, with extra columns whose names clash with inner ones."""

    def make(rows):
        made = spark.createDataFrame(rows, DOCS)
        return made.selectExpr("doc_id", "text", "'x' AS score", "1 AS _fp", "'y' AS _spans", "0 AS length")

    return make


#: Nulls, empty, blank, repeated and very long rows; each operator must pass over these without crashing.
ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "no id here, just words"),
    (None, None),
    (4, "same row"),
    (4, "same row"),
    (5, "😀 émoji and ünicode ​ text"),
    (6, "long " * 30_000),
    (7, "x" * 50_000),
]
