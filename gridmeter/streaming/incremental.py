"""Harvest datasets as their report records land.

A Structured Streaming file source watches `<landing>/reports`; its
checkpoint remembers which files were processed (exactly once, and a failed
run resumes where it stopped).  Each micro-batch re-harvests the datasets its
new records belong to: the dataset ids go to the batch harvest as a
DataFrame (a semi-join, nothing collected), which rewrites those datasets'
partitions whole.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from gridmeter.schemas import LANDED


def harvest_stream(spark: SparkSession, landing: str, out: str, checkpoint: str | None = None,
                   available_now: bool = True, **keys):
    """Start the stream; with `available_now` it processes what has landed and stops.

    The stream checkpoint defaults to a folder inside the cluster's shared
    checkpoint directory (`spark.checkpoint.dir`), named after the landing
    and output paths so a restart resumes it and two streams never share it.
    """
    from gridmeter.plans.harvest import harvest
    from gridmeter.session import scratch_path
    if checkpoint is None:
        # One stream state per (landing, output) pair, stable across restarts.
        key = hashlib.sha1(f"{landing}|{out}".encode()).hexdigest()[:16]
        checkpoint = scratch_path(spark, f"harvest_stream-{key}")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        ids = batch.select("dataset_id").distinct()
        harvest(spark, landing, out, include=ids, **keys)

    stream = spark.readStream.schema(LANDED["reports"]).json(f"{landing}/reports")
    writer = (stream.writeStream.foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
