"""Table copy with row filters and duplicate-safe inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmeter.sources.sinks import read_table


def resource_reports(task_stat: DataFrame) -> DataFrame:
    """Reports worth copying: text longer than 8 that mentions resources.

    The match ignores case, as the source store's LIKE does for ASCII.
    """
    return task_stat.where((F.length("stat") > 8) & F.col("stat").ilike("%resources%"))


def first_per_key(batch: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by `order` (default: all columns).

    Expressed as `min(struct(order..., row))` per key, an aggregate with
    partial aggregation: a key repeated across a third of the batch is
    reduced inside every input partition before the shuffle, instead of
    being sorted whole in one window partition.  (The row struct is not fixed
    in width, so Spark sorts each input partition for it.)  The keys come
    from the grouping columns, so what follows on the same keys needs no
    second shuffle.
    """
    order = order or [c for c in batch.columns]
    rest = [c for c in batch.columns if c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    agg = batch.groupBy(*key).agg(F.min(packed).alias("_row"))
    return agg.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def new_rows(target: DataFrame | None, batch: DataFrame, key: list[str],
             order: list[str] | None = None) -> DataFrame:
    """The rows of `batch` that an insert ignoring existing keys would add.

    A key present in the target adds nothing; a key repeated within the
    batch adds its first row by `order` (default: all columns, a total order).
    """
    new = first_per_key(batch, key, order)
    return new if target is None else new.join(target.select(*key), key, "left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame | None, batch: DataFrame, key: list[str],
                  order: list[str] | None = None) -> DataFrame:
    """Target rows plus `new_rows`, as one DataFrame."""
    new = new_rows(target, batch, key, order)
    return new if target is None else target.unionByName(new.select(*target.columns))


def copy_table(source: DataFrame, path: str, key: list[str], predicate=None) -> DataFrame:
    """Copy the rows of `source` matching `predicate` into the Parquet table at
    `path` (insert-ignore): only rows with new keys are appended, the table's
    own rows are neither rewritten nor shuffled as a whole.  Returns the table."""
    spark = source.sparkSession
    rows = source.where(predicate) if predicate is not None else source
    target = read_table(spark, path, source.schema)
    new_rows(target, rows, key).write.mode("append").parquet(path)
    return spark.read.schema(source.schema).parquet(path)
