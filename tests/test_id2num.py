import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmeter.functions.ids import id2num, register_sql_functions

ALPHABET = string.ascii_letters + string.digits


def reference(val):
    """Plain big-integer arithmetic of the documented rule."""
    if val is None:
        return None
    if val == "":
        return -1
    total = 0
    for ch in val:
        c = ord(ch)
        d = c - 96 if c >= 97 else (c - 38 if c >= 65 else c + 5)
        total = total * 62 + d
    return (total - 1) % 10 ** 15


def test_known_id(spark):
    df = spark.createDataFrame([("O1r99c57luMXkK",), ("",), (None,), ("a",), ("9",)], "v string")
    for form in ("v", F.col("v")):             # SQL-text form and Column form
        got = [r[0] for r in df.select(id2num(form)).collect()]
        assert got == [20014, -1, None, 0, 61]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, min_size=1, max_size=21), min_size=1, max_size=20))
def test_matches_big_integers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(id2num("v").alias("a"), id2num(F.col("v")).alias("b")).collect()
    assert [r["a"] for r in rows] == [reference(v) for v in values]
    assert [r["b"] for r in rows] == [reference(v) for v in values]


def test_sql_function(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT id2num('O1r99c57luMXkK') AS n").first()["n"] == 20014
    assert spark.sql("SELECT id2num('#-') AS n").first()["n"] == reference("#-")
