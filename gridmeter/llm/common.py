"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word rule (space, tab to carriage return), and a word.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def crc_fold(col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds` (null ids: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(folds)


def unit_hash(*cols: Column) -> Column:
    """A fixed uniform number in [0, 1) from the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(2 ** 53))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have (in any case)."""
    taken, name = {c.lower() for c in df.columns}, f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name
