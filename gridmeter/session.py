"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on.  AQE re-plans joins from runtime sizes (a join
# side is broadcast only when its measured size is under the threshold) and
# splits skewed shuffle partitions; both matter when one dataset or task holds
# a large share of all rows.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "gridmeter",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Get or create a session with the defaults above (caller values win)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system every executor can reach).  Only when it is unset and the
    master is local, as in tests, a fresh folder under the system temp dir is
    made and registered; on a cluster that is an error, since executors would
    each write to their own disk.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="gridmeter-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def materialize(df, name: str, with_path: bool = False):
    """Write `df` once as a Parquet table in the shared checkpoint folder and
    read it back: the lineage is cut and the data is computed exactly once
    (a reliable `checkpoint()` of an unpersisted plan computes it twice).
    With `with_path`, also return the table's path (to drop it when done)."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    out = spark.read.parquet(path)
    return (out, path) if with_path else out


def drop_path(spark: SparkSession, path: str) -> None:
    """Empty a scratch table written by `materialize`: overwritten by a table
    without rows, which removes its files through the writer of any store."""
    spark.range(0).write.mode("overwrite").parquet(path)
