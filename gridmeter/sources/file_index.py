"""Which landed file holds which datasets, so that a work list chooses files.

The index is a Parquet table that grows with the landing: a row per (kind, file,
dataset) of every file read so far.  A refresh lists the landing and reads only files
that are new or have changed since (by modification time and length), narrowly: ids, no
requirements and no reports.  Task documents may name another dataset than their
record; such rows are `foreign`, and their files are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.schemas import DATASET_DOC
from gridmeter.sources.landed import read_landed
from gridmeter.sources.sinks import read_table

KINDS = ("datasets", "tasks", "jobs", "reports")
SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("dataset", T.LongType()),
    T.StructField("foreign", T.BooleanType()),
])
# Up to this many chosen files are named to the reader; more become a join on the file.
MAX_NAMED_FILES = 10_000
# Ids alone of task documents.
_TASK_IDS = "MAP<STRING, STRUCT<dataset_id: STRING>>"


def listed(spark: SparkSession, landing: str, kind: str) -> DataFrame:
    """(kind, file, path, modified, length) of every landed file of a kind, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{landing}/{kind}")
    return files.select(F.lit(kind).alias("kind"), F.col("_metadata.file_path").alias("file"), "path",
                        F.col("modificationTime").alias("modified"), "length")


def listing(spark: SparkSession, landing: str) -> DataFrame:
    return reduce(DataFrame.unionAll, [listed(spark, landing, k) for k in KINDS])


def datasets_of(raw: DataFrame, kind: str) -> DataFrame:
    """(file, dataset_id, dataset, foreign): the datasets that landed records of a kind, with
    their file as `_file`, are about."""
    file = F.col("_file").alias("file")
    no, none = F.lit(False).alias("foreign"), F.lit(None).cast("bigint").alias("dataset")
    if kind == "datasets":
        e = raw.select(file, F.explode_outer(F.from_json("doc", DATASET_DOC)).alias("key", "v"))
        rows = e.select("file", F.coalesce("v.dataset_id", "key").alias("dataset_id"), F.col("v.dataset").cast("bigint").alias("dataset"), no)
    elif kind == "tasks":
        e = raw.select(file, "dataset_id", F.explode_outer(F.from_json("doc", _TASK_IDS)).alias("key", "v"))
        own = F.coalesce(F.col("v.dataset_id"), F.col("dataset_id"))
        rows = e.select("file", own.alias("dataset_id"), none, (~own.eqNullSafe(F.col("dataset_id"))).alias("foreign"))
    else:
        rows = raw.select(file, "dataset_id", none, no)
    return rows.distinct()


def named(spark: SparkSession, landing: str, kind: str, files: DataFrame, keep_file: bool = False) -> DataFrame:
    """The landed records of the given files (file, path) of a kind, with their file as
    `_file` if that is kept.

    They are named to the reader, which then opens nothing else; beyond
    `MAX_NAMED_FILES` the listing is joined with them by file.
    """
    paths = [r["path"] for r in files.select("path").limit(MAX_NAMED_FILES + 1).collect()]
    if len(paths) <= MAX_NAMED_FILES:
        raw = read_landed(spark, landing, kind, paths)
        return raw.withColumn("_file", F.col("_metadata.file_path")) if keep_file else raw
    raw = read_landed(spark, landing, kind).withColumn("_file", F.col("_metadata.file_path"))
    found = raw.join(files.select(F.col("file").alias("_file")), "_file", "left_semi")
    return found if keep_file else found.drop("_file")


def refresh(spark: SparkSession, landing: str, path: str) -> DataFrame:
    """Bring the index at `path` up to date with the landing; returns its rows of the
    files that are there now, with the `path` to read each by."""
    now = listing(spark, landing)
    known = read_table(spark, path, SCHEMA)
    stamp = ["kind", "file", "modified", "length"]
    new = now if known is None else now.join(known.select(*stamp).distinct(), stamp, "left_anti")
    found = []
    for kind in KINDS:
        files = new.where(F.col("kind") == kind)
        if not files.isEmpty():
            raw = named(spark, landing, kind, files, keep_file=True)
            found.append(datasets_of(raw, kind).join(files.drop("path"), "file").select(*SCHEMA.fieldNames()))
    if found:
        reduce(DataFrame.unionAll, found).write.mode("append").parquet(path)
    index = read_table(spark, path, SCHEMA)
    if index is None:
        index = spark.createDataFrame([], SCHEMA)
    # A file that changed has rows of its earlier content as well: only those of its stamp count.
    return index.join(now, stamp)


def files_of(index: DataFrame, kind: str, ids: DataFrame, unreadable: bool = False) -> DataFrame:
    """(file, path, foreign) of the files of a kind that hold a dataset of `ids`; with
    `unreadable` also those with a record that names no dataset."""
    rows = index.where(F.col("kind") == kind)
    hit = rows.join(ids.select("dataset_id").distinct(), "dataset_id", "left_semi").select("file")
    if unreadable:
        hit = hit.unionAll(rows.where(F.col("dataset_id").isNull()).select("file"))
    files = rows.groupBy("file", "path").agg(F.max("foreign").alias("foreign"))
    return files.join(hit.distinct(), "file", "left_semi")
