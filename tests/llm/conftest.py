import pytest
from pyspark.sql import types as T

#: A documents table with the columns that operators use inside, and what breaks careless ones.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("h", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("score", T.StringType())])


@pytest.fixture
def documents(spark):
    """``documents([(id, text), ...])``: a DataFrame with extra columns of clashing names."""
    def make(rows, partitions=3):
        return spark.createDataFrame([(i, t, None, "x", None, "y", "z") for i, t in rows], SCHEMA).repartition(partitions)
    return make


LONG = "wörd " * 30_000


@pytest.fixture
def odd(documents):
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    return documents([
        (1, None), (2, ""), (3, " \t\r\n "), (4, "one"), (5, "One two"), (5, "One two"), (6, "one TWO"), (None, "one two"),
        (None, None), (7, LONG), (8, LONG), (9, "日本語 テキスト 🏳️‍🌈 ÀÉ"), (10, "a\x00b \\ <|end|> |> <|"), (11, "  lead  and   trail \n\n\n x "),
        (12, "x" * 2000), (13, "The THE the " * 40), (14, "don't we'll 123 4567 !!!??")])
