import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Columns whose names an operator might use inside.
CLASHING = ["id", "uid", "row", "key", "digest", "fp", "ids", "score", "n", "size", "s", "shard", "block", "words", "host",
            "path", "rule", "verdict", "__key", "__uid", "mix_size", "lang_pred", "k", "y", "start", "h", "target",
            "_block", "_blocks", "got", "_p", "_place", "__block", "__place", "mix_shard", "_salt", "_v", "labels", "tree", "idx", "node", "path_"]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_rows():
    """Null in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat again", "en", "a", 28), (2, "the cat sat on the mat again", "en", "a", 28),
        (2, "the cat sat on the mat again", "en", "a", 28), (3, "the  cat\tsat on the mat again", "en", "b", 29),
        (4, None, "en", "a", 0), (5, "", "fr", "b", 0), (6, " \n\t ", "fr", None, 4), (7, None, None, None, None),
        (None, "ein Hund und noch ein Hund", "de", "c", 26), (None, "ein Hund und noch ein Hund", "de", "c", 26),
        (None, None, None, None, None), (8, long, "en", "a", len(long)), (9, "aaaa" * 300, "en", "b", 1200),
        (10, "日本語のテキスト 😀 émigré <|endoftext|> 　x\u0000y", "ja", "b", 30), (11, "12345 !!! ???", None, "c", 13),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns of clashing names."""
    df = spark.createDataFrame(odd_rows(), DOCS)
    return df.withColumns({c: F.lit("extra") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(tmp, name, df):
    """A folder like the driver's, with one table."""
    path = os.path.join(tmp, f"{name}.parquet")
    df.write.mode("overwrite").parquet(path)
    return tmp
