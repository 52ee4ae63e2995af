"""id2num: map a textual id to a number (bijective base 62).

Each character is a digit: a-z are 1..26, A-Z are 27..52, and every other
character (digits 0-9 in practice) is its code + 5, so 0-9 become 53..62.  The
id's value is the base-62 number of those digits, minus 1, modulo 10^15.

Evaluated with Horner's rule and the modulus applied at each step, so every
intermediate stays below 62 * 10^15 and fits a BIGINT for ids of any length.
The empty string gives -1 and NULL gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gridmeter.constants import ID_BASE as BASE
from gridmeter.constants import ID_MODULUS as MODULUS


def _body(val: str) -> str:
    """The id2num SQL expression over the SQL expression `val`."""
    return f"""CASE WHEN {val} IS NULL THEN CAST(NULL AS BIGINT)
       WHEN {val} = '' THEN CAST(-1 AS BIGINT)
       ELSE pmod(aggregate(split({val}, ''), CAST(0 AS BIGINT),
              (acc, ch) -> pmod(acc * {BASE} + CASE WHEN ascii(ch) >= 97 THEN ascii(ch) - 96
                                                   WHEN ascii(ch) >= 65 THEN ascii(ch) - 38
                                                   ELSE ascii(ch) + 5 END,
                                CAST({MODULUS} AS BIGINT))) - 1, CAST({MODULUS} AS BIGINT))
  END"""


def _digit(ch: Column) -> Column:
    code = F.ascii(ch).cast("bigint")
    return (F.when(code >= 97, code - 96)
             .when(code >= 65, code - 38)
             .otherwise(code + 5))


def id2num(val: Column | str) -> Column:
    """BIGINT number of a textual id (see module doc).

    A column name uses the SQL form (one expression parse); an arbitrary
    Column expression uses the same rule built from Column operations.
    """
    if isinstance(val, str):
        return F.expr(_body(f"`{val}`"))
    horner = F.aggregate(
        F.split(val, ""),
        F.lit(0).cast("bigint"),
        lambda acc, ch: F.pmod(acc * BASE + _digit(ch), F.lit(MODULUS)),
    )
    return (F.when(val.isNull(), F.lit(None).cast("bigint"))
             .when(val == "", F.lit(-1).cast("bigint"))
             .otherwise(F.pmod(horner - 1, F.lit(MODULUS))))


# The same function for SQL users, as a SQL-bodied temporary function (no
# Python in the execution path).
ID2NUM_SQL = ("CREATE OR REPLACE TEMPORARY FUNCTION id2num(val STRING) RETURNS BIGINT RETURN "
              + _body("val"))


def register_sql_functions(spark: SparkSession) -> None:
    """Make `id2num(text)` callable from spark.sql in this session."""
    spark.sql(ID2NUM_SQL)


# Ids up to this many bytes have a fixed-width key.
MAX_KEY_BYTES = 15


def fixed_width_key(name: str) -> str:
    """SQL: a byte-string id as a DECIMAL(38,0) that orders like the bytes do: the bytes,
    padded with zeros to 15, then the length.  Being fixed in width it can sit in a
    hash aggregate's buffer.  Raises on a longer id instead of cutting it."""
    padded = f"rpad(hex({name}), {2 * MAX_KEY_BYTES}, '0')"
    high = f"CAST(conv(substring({padded}, 1, 14), 16, 10) AS DECIMAL(38,0))"
    low = f"CAST(conv(substring({padded}, 15, 16), 16, 10) AS DECIMAL(38,0))"
    value = (f"CAST(({high} * CAST(18446744073709551616 AS DECIMAL(38,0)) + {low}) * 16 "
             f"+ octet_length({name}) AS DECIMAL(38,0))")
    return (f"CASE WHEN octet_length({name}) > {MAX_KEY_BYTES} "
            f"THEN CAST(raise_error('id of more than {MAX_KEY_BYTES} bytes') AS DECIMAL(38,0)) ELSE {value} END")
