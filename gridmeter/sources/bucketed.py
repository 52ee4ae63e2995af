"""Tables bucketed and sorted by the key their joins are on, so that these need no shuffle.

`task`, `search` and `task_stat` meet on `task_id`: written in as many buckets each, the
rollup is computed bucket by bucket and joins the other two where it lies.  The files
are Parquet under a folder; a session that did not write them opens them by the same
folder and number of buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridmeter.sources.tables import Tables

# The key of each table that is joined by it.
BUCKET_KEYS = {"task": "task_id", "search": "task_id", "task_stat": "task_id"}


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write `df` at `path` in `buckets` files by a hash of `key`, each sorted by it."""
    # One writing task per bucket, so that a bucket is one file and its order holds.
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).mode("overwrite").saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay: the table's place was given


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The table that `write_bucketed` left at `path`, known to be bucketed.  It is registered in
    the session's catalog under a name of its own, without copying anything."""
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def store_tables(tables: Tables, path: str, buckets: int) -> None:
    """Write all tables under `path`, those of `BUCKET_KEYS` bucketed."""
    for name, df in tables.items():
        if name in BUCKET_KEYS:
            write_bucketed(df, f"{path}/{name}", BUCKET_KEYS[name], buckets)
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")


def open_tables(spark: SparkSession, path: str, buckets: int) -> Tables:
    """The tables that `store_tables` wrote."""
    return Tables(**{name: open_bucketed(spark, f"{path}/{name}", BUCKET_KEYS[name], buckets) if name in BUCKET_KEYS
                     else spark.read.parquet(f"{path}/{name}")
                     for name in ("task", "task_rel", "search", "job", "task_stat", "dataset")})
