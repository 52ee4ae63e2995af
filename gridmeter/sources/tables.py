"""Scan of the six relational tables (S6) and their load-time normalisation."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.functions.text import decode_bytes
from gridmeter.schemas import DEFAULT_ZERO, TABLES, TEXT_COLUMNS


@dataclass(frozen=True)
class Tables:
    """The relational inputs of the table path."""

    task: DataFrame
    task_rel: DataFrame
    search: DataFrame
    job: DataFrame
    task_stat: DataFrame
    dataset: DataFrame | None = None

    def items(self):
        for f in fields(self):
            df = getattr(self, f.name)
            if df is not None:
                yield f.name, df


def read_tables(spark: SparkSession, path: str, fmt: str = "parquet") -> Tables:
    """Read `<path>/<table>` for each table with its declared schema."""
    def load(name):
        return spark.read.schema(TABLES[name]).format(fmt).load(f"{path}/{name}")
    return Tables(**{name: load(name) for name in
                     ("task", "task_rel", "search", "job", "task_stat", "dataset")})


def read_jdbc_tables(spark: SparkSession, url: str, properties: dict[str, str],
                     predicates: dict[str, list[str]] | None = None) -> Tables:
    """Read the tables from a live database.

    `predicates` gives, per table, a list of WHERE fragments; each becomes one
    partition read in parallel (ids are byte strings, so range partitioning
    on a numeric column is not available).
    """
    predicates = predicates or {}

    def load(name):
        cols = ", ".join(f.name for f in TABLES[name].fields)
        query = f"(SELECT {cols} FROM {name}) AS t"
        if name in predicates:
            return spark.read.jdbc(url, query, predicates=predicates[name], properties=properties)
        return spark.read.jdbc(url, query, properties=properties)
    return Tables(**{name: load(name) for name in
                     ("task", "task_rel", "search", "job", "task_stat", "dataset")})


def normalize(tables: Tables) -> Tables:
    """Decode byte-string text columns and apply the integer column defaults.

    Join keys are left in their stored type: byte-string keys join as bytes.
    """
    out = {}
    for name, df in tables.items():
        cols = set(df.columns)
        decode = {c: decode_bytes(c) for c in TEXT_COLUMNS.get(name, [])
                  if c in cols and str(df.schema[c].dataType) == "BinaryType()"}
        if decode:
            df = df.withColumns(decode)
        zeros = [c for c in DEFAULT_ZERO.get(name, []) if c in cols]
        if zeros:
            df = df.na.fill(0, subset=zeros)
        out[name] = df
    return replace(tables, **out)


def scan_counts(tables: Tables) -> DataFrame:
    """(table, column_name, n_rows, n_values): rows, and values that are there, of every
    column of every table (one aggregate per scan)."""
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in df.columns])
        part = counts.select("n", F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in df.columns])).alias("s")
        ).select(F.lit(name).alias("table"), "s.column_name", F.col("n").alias("n_rows"), "s.n_values")
        out = part if out is None else out.unionByName(part)
    return out
