"""Key index of a stored table: inserts that ignore known keys without shuffling the table's keys.

Beside a Parquet table lie its keys, bucketed and sorted, so the anti-join of a batch
shuffles the batch alone.  The index follows the table: before it is used, the keys of
files that it has not seen (those of the last insert, or of anyone else's) are added.
So a lost insert or a lost index write leaves nothing wrong: a key that is there twice
still is one key.

  <index>/keys    the keys, bucketed by their first column
  <index>/files   the files of the table whose keys are there
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.operators.copy import first_per_key
from gridmeter.session import drop_path, materialize
from gridmeter.sources.sinks import read_table

# Up to this many new files are a literal filter, which opens them alone; more a join.
MAX_NAMED_FILES = 10_000
FILES = T.StructType([T.StructField("file", T.StringType())])


class KeyIndex:
    """Index at `path` of the table at `table`, by the columns `key` of `schema`."""

    def __init__(self, spark: SparkSession, table: str, path: str, key: list[str], schema: T.StructType, buckets: int = 64):
        self.spark, self.table, self.path, self.key, self.schema, self.buckets = spark, table, path, key, schema, buckets
        self.name = f"keys_{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in key)
        names = ", ".join(f"`{c}`" for c in key)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}/keys'")

    def follow(self) -> None:
        """Add the keys of the table's files that the index has not seen."""
        stored = read_table(self.spark, self.table, self.schema)
        if stored is None:
            return
        stored = stored.select(*self.key, F.col("_metadata.file_path").alias("file"))
        seen = read_table(self.spark, f"{self.path}/files", FILES)
        there = self.spark.read.format("binaryFile").load(self.table).select(F.col("_metadata.file_path").alias("file"))
        # Written down first: what is read below is what is marked as seen.
        new, path = materialize(there if seen is None else there.join(seen, "file", "left_anti"), "new-files", with_path=True)
        few = [r["file"] for r in new.limit(MAX_NAMED_FILES + 1).collect()]
        if few:
            rows = (stored.where(F.col("file").isin(few)) if len(few) <= MAX_NAMED_FILES
                    else stored.join(new, "file", "left_semi"))
            rows.select(*self.key).repartition(self.buckets, *self.key).write.mode("append").insertInto(self.name)
            new.write.mode("append").parquet(f"{self.path}/files")
        drop_path(self.spark, path)

    def new_rows(self, batch: DataFrame, order: list[str] | None = None) -> DataFrame:
        """The rows of `batch` that an insert would add: per key its first row, if the table has
        no such key.  One shuffle, of the batch."""
        first = first_per_key(batch.repartition(self.buckets, *self.key), self.key, order)
        return first.join(self.spark.table(self.name).hint("merge"), self.key, "left_anti").select(*batch.columns)

    def insert(self, batch: DataFrame, order: list[str] | None = None) -> DataFrame:
        """Append the new rows of `batch` to the table (columns as in `schema`); returns the table."""
        self.follow()
        self.new_rows(batch, order).select(*self.schema.fieldNames()).write.mode("append").parquet(self.table)
        return self.spark.read.schema(self.schema).parquet(self.table)
