"""Registered queries: one per operator of the inventory, each with its oracle.

Each query takes (spark, sf_dir) and returns a DataFrame computed by the
engine over the whole driver tables (through the derived views).  Its oracle
is one DuckDB statement over the same raw tables.  Doubles are rounded to 6
places on both sides; every other value compares exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round top-level double columns (the comparison convention)."""
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def query(name: str, oracle: str | None = None):
    """Register `fn(spark, sf_dir) -> DataFrame` under `name` with its oracle."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return wrap


def _load_all() -> None:
    # Importing the modules registers their queries.
    from gridmeter.catalog import documents_q, functions_q, storage_q, tables_q  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
