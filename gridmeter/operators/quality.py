"""Table contracts checked as Spark jobs: keys, references, required columns, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys occurring more than once, with their count (partial aggregation first)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent row (anti join); a NULL reference
    is none."""
    p = parent.select(F.col(parent_column).alias("_ref"))
    return child.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("_ref"), "left_anti")


def check_references(tables: dict[str, DataFrame], references) -> DataFrame:
    """(child, column_name, parent, n_orphans) for every reference between present tables.

    All references of a parent are one aggregate: its keys and the keys of its children,
    tagged, are counted by key and tag before the one shuffle (so a reference that a
    third of the rows hold is one row per input partition there), and keys that no
    parent row has give their counts as orphans.  A NULL reference is none.
    """
    by_parent: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, col, parent, pcol in references:
        if child in tables and parent in tables:
            by_parent.setdefault((parent, pcol), []).append((child, col))
    out = None
    for (parent, pcol), children in by_parent.items():
        keys = tables[parent].select(F.col(pcol).alias("key"), F.lit(-1).alias("tag"))
        kind = keys.schema["key"].dataType
        for tag, (child, col) in enumerate(children):
            keys = keys.unionAll(tables[child].where(F.col(col).isNotNull()).select(F.col(col).cast(kind).alias("key"), F.lit(tag).alias("tag")))
        counts = [F.count(F.when(F.col("tag") == tag, 1)) for tag in range(len(children))]
        per_key = keys.groupBy("key").agg(F.min("tag").alias("first"), *[c.alias(f"n{t}") for t, c in enumerate(counts)])
        sums = per_key.where("first >= 0").agg(*[F.coalesce(F.sum(f"n{t}"), F.lit(0)).alias(f"n{t}") for t in range(len(children))])
        rows = F.array(*[F.struct(F.lit(child).alias("child"), F.lit(col).alias("column_name"), F.lit(parent).alias("parent"),
                                  F.col(f"n{t}").alias("n_orphans")) for t, (child, col) in enumerate(children)])
        part = sums.select(F.explode(rows).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


def check_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """(table_name, n_keys, n_rows): repeated primary keys of each table, and their rows."""
    parts = [check_unique(df, keys[name]).agg(F.count(F.lit(1)).alias("n_keys"),
                                              F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_keys", "n_rows")
             for name, df in tables.items() if name in keys]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_required(tables: dict[str, DataFrame], schemas) -> DataFrame:
    """`check_not_null` of the required columns that each table has."""
    out = None
    for name, df in tables.items():
        required = [f.name for f in schemas[name].fields if not f.nullable and f.name in df.columns]
        part = check_not_null(df.select(*required), name)
        out = part if out is None else out.unionByName(part)
    return out


def check_not_null(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, n_null) for every column, from one scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.col(c).alias("n_null")) for c in df.columns]))
    return counts.select(stacked.alias("s")).select(
        F.lit(table).alias("table_name"), "s.column_name", "s.n_null")


def fill_defaults(df: DataFrame, columns: list[str], value=0) -> DataFrame:
    """Column defaults applied at load: NULL in `columns` becomes `value`."""
    return df.na.fill(value, subset=columns)
