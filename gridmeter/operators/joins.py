"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when a check shows it within both limits.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _size_terms(df: DataFrame):
    """Fixed bytes per row, and byte-length expressions for the other columns."""
    fixed, variable = 8, []          # 8: per-row overhead of the row format
    for f in df.schema.fields:
        width = _FIXED_WIDTH.get(type(f.dataType))
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            variable.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:                        # nested values: their JSON text length bounds them
            fixed += 8
            variable.append(F.coalesce(F.length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    return fixed, variable


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of `df`: one partial aggregate over all its columns, so one row
    per partition reaches the last step."""
    fixed, variable = _size_terms(df)
    total = sum(variable[1:], variable[0]) if variable else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("v")).first()
    n, v = row["n"], row["v"] or 0
    return n, n * fixed + v


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast `df` only after measuring that it is small.

    The check counts the rows and sums the byte length of every variable-width
    column, so the size bound is proven, not estimated from file sizes.  A larger
    side is returned unchanged and joins by shuffle, where AQE can still split
    skewed partitions.
    """
    n, nbytes = measured_size(df)
    return F.broadcast(df) if n <= max_rows and nbytes <= max_bytes else df
