import pytest
from pyspark.sql import types as T

LONG = "word " * 30000 + "end"

# Null in every column, empty and very long texts, ties, repeated rows; `text` also stands under names that operators use.
EDGE = [
    (1, "plain words about nothing in particular that run on for more than ten words", "s", 5),
    (1, "plain words about nothing in particular that run on for more than ten words", "s", 5),
    (2, "", "s", 0),
    (3, None, None, None),
    (None, "a text without an id that still has quite a few words in it, enough to be kept", "t", 7),
    (4, LONG, "t", 1),
    (5, "   \n\n\t ", "", 2),
    (6, "über straße \U0001f600 日本 \x00 ▁ end", "s", 3),
]
EDGE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_words", T.LongType()),
])


@pytest.fixture(scope="session")
def edge(spark):
    """Rows every operator has to take, with a column of a name that some operators give."""
    return spark.createDataFrame(EDGE, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
