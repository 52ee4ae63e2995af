"""Scans of landed listing documents.

Listings arrive as JSON Lines, each record holding a `doc`: an object keyed by
id.  Contract: a record holds one entity (or a few; a record is one row and
is parsed by one task), so a dataset's listing is spread over many records.
`doc` is read as a string and parsed with an explicit map schema so key order,
i.e. document order, is kept; `posexplode` turns the keys into rows.  Reports
are one record per task holding that task's whole report object.

Documents may land again.  Every record has a landing order (its `landed_at`,
else the file's modification time; ties by file and content), and of the
documents of one entity the newest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmeter.constants import COMPLETE_STATUS
from gridmeter.schemas import CORRUPT, DATASET_DOC, JOB_DOC, LANDED, TASK_DOC

# Landing order as one fixed-width number: the time, then a hash that settles ties.
_ORDER = ("CAST(coalesce(landed_at, unix_micros(_metadata.file_modification_time)) AS DECIMAL(38,0)) "
          "* 18446744073709551616 + CAST(xxhash64(_metadata.file_path, doc) AS DECIMAL(20,0))")


def read_landed(spark: SparkSession, landing: str, kind: str, files: list[str] | None = None) -> DataFrame:
    """Raw landed records of one kind: `<landing>/<kind>/*.jsonl`, with their
    landing order `landed`.  A line that is not JSON keeps its text in
    `_corrupt` and has no other value (see `corrupt_records`).  With `files` only
    these are opened (none: no records)."""
    schema = f"{LANDED[kind]}, {CORRUPT} STRING"
    if files == []:
        return spark.createDataFrame([], f"{schema}, landed DECIMAL(38,0)").drop("landed_at")
    # Folders such as dataset_id=... below the kind's give columns, also of named files.
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("basePath", f"{landing}/{kind}")
    raw = reader.json(files or f"{landing}/{kind}")
    return raw.withColumn("landed", F.expr(_ORDER)).drop("landed_at")


def _foreign(raw: DataFrame, kind: str):
    """True for a task record that names another dataset than one of its documents does."""
    if kind != "tasks":
        return F.lit(False)
    ids = F.map_values(F.from_json("doc", "MAP<STRING, STRUCT<dataset_id: STRING>>"))
    return F.coalesce(F.exists(ids, lambda v: v["dataset_id"] != F.col("dataset_id")), F.lit(False))


def corrupt_records(raw: DataFrame, kind: str) -> DataFrame:
    """(kind, reason, text): landed lines and listing documents that cannot be read, and task
    records that name another dataset than their document (which counts for its own)."""
    doc = {"datasets": DATASET_DOC, "tasks": TASK_DOC, "jobs": JOB_DOC}.get(kind)
    line = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    bad = F.col("doc").isNotNull() & F.json_object_keys("doc").isNull() if doc else F.lit(False)
    text = F.coalesce(F.col(CORRUPT), F.col("doc")) if CORRUPT in raw.columns else F.col("doc")
    return raw.select(F.lit(kind).alias("kind"),
                      F.when(line, "corrupt_line").when(bad, "corrupt_document")
                      .when(_foreign(raw, kind), "other_dataset").alias("reason"),
                      text.alias("text")).where(F.col("reason").isNotNull())


def checked(raw: DataFrame, kind: str) -> DataFrame:
    """`raw`, raising at run time on a record that cannot be read (strict mode)."""
    line = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    bad = line | (F.col("doc").isNotNull() & F.json_object_keys("doc").isNull()) | _foreign(raw, kind)
    out = raw.withColumn("_chk", F.when(bad, F.raise_error(F.lit(f"unreadable record in {kind}"))))
    return out.where(F.col("_chk").isNull()).drop("_chk")


def newest(rows: DataFrame, *keys: str) -> DataFrame:
    """The newest row per key by landing order; rows without a landing order are taken as
    they are.  Ranked by a window whose partitioning and order the joins on the same
    keys use again; Spark keeps the first of each key before the shuffle, so a key that
    landed very often is one row per input partition there."""
    if "landed" not in rows.columns:
        return rows
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("landed").desc()))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place", "landed")


def _explode(raw: DataFrame, schema: str, *keep: str) -> DataFrame:
    order = ["landed"] if "landed" in raw.columns else []
    return raw.select(*keep, *order, F.posexplode(F.from_json("doc", schema)).alias("pos", "key", "v"))


def _order(rows: DataFrame) -> list[str]:
    return ["landed"] if "landed" in rows.columns else []


def scan_datasets(raw: DataFrame) -> DataFrame:
    """Dataset listing -> (dataset, dataset_id, pos)."""
    e = _explode(raw, DATASET_DOC)
    return newest(e.select(
        F.col("v.dataset").alias("dataset"),
        F.coalesce(F.col("v.dataset_id"), F.col("key")).alias("dataset_id"), "pos", *_order(e)),
        "dataset_id")


def scan_tasks(raw: DataFrame, status: str | None = COMPLETE_STATUS, of=None) -> DataFrame:
    """Task listing -> one row per task; the status filter applies to the
    newest document of each task.  The document's dataset counts, the record's only
    where it has none; `of` (rows to rows) selects datasets by it before the shuffle."""
    e = _explode(raw, TASK_DOC, "dataset_id")
    t = e.select(
        F.coalesce(F.col("v.dataset_id"), F.col("dataset_id")).alias("dataset_id"),
        F.col("v.job_id").alias("job_id"),
        F.coalesce(F.col("v.task_id"), F.col("key")).alias("task_id"),
        F.col("v.task_index").alias("task_index"),
        F.col("v.requirements").alias("requirements"),
        F.col("v.status").alias("status"), *_order(e))
    t = newest(of(t) if of else t, "dataset_id", "task_id")
    return t.where(F.col("status") == status) if status else t


def scan_jobs(raw: DataFrame) -> DataFrame:
    """S3: job listing -> (dataset_id, job_id, job_index)."""
    e = _explode(raw, JOB_DOC, "dataset_id")
    return newest(e.select(
        "dataset_id", F.col("key").alias("job_id"), F.col("v.job_index").alias("job_index"), *_order(e)),
        "dataset_id", "job_id")


def scan_reports(raw: DataFrame) -> DataFrame:
    """S4 (raw form): one row per landed report document, text and landing order
    (the newest per task is chosen from the figures, so no text is shuffled)."""
    return raw.where(F.col("task_id").isNotNull()).select("dataset_id", "task_id", "doc", *_order(raw))


def scan_configs(raw: DataFrame) -> DataFrame:
    """Configuration documents, raw JSON text kept as is."""
    return newest(raw.where(F.col("dataset_id").isNotNull()).select(
        "dataset_id", F.col("doc").alias("config"), *_order(raw)), "dataset_id")
