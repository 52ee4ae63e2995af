"""Byte decoding and the name rules of the table copy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_bytes(col: Column | str) -> Column:
    """Bytes to text (UTF-8).  Plain ASCII round-trips unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    return F.decode(c, "UTF-8")


def name_above(col: Column | str, n: float) -> Column:
    """`name > n` as a dynamically typed store compares it.

    Numeric names compare as numbers; a text name always sorts above any
    number, so it passes.
    """
    c = F.col(col) if isinstance(col, str) else col
    num = c.cast("string").try_cast("double")
    return num.isNull() | (num > F.lit(float(n)))


def name_not_equal(col: Column | str, value: float) -> Column:
    """`name != value` with numeric comparison for numeric names."""
    c = F.col(col) if isinstance(col, str) else col
    num = c.cast("string").try_cast("double")
    return num.isNull() | (num != F.lit(float(value)))
