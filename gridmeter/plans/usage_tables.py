"""Per-task usage from the relational tables (table path).

Plan shape (one scan and one parse of the big report table):

    task_stat --parse once--> per-report figures --groupBy(task_id)--> rollup
    rollup(n_ok > 0, output_size > 0)
      JOIN task     ON task_id          (co-partitioned on task_id with rollup)
      JOIN search   ON task_id          (status = 'complete' pushed into the scan)
      JOIN task_rel ON task_rel_id      (memory not '$eval…'; broadcast when a row count
                                         proves it small, else shuffled)
      JOIN job      ON job_id           (shuffle; AQE may broadcast from measured size)
    -> memory requests, id2num(dataset_id) -> 17 columns

Requirement JSON is reduced to (present, value) next to each scan, so no JSON
text travels through a shuffle.  All joins are equi-joins on keys; skewed keys
(one type or job with very many tasks) are split by AQE's skew-join handling.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.constants import COMPLETE_STATUS, PARAMETER_PREFIX
from gridmeter.functions.ids import id2num
from gridmeter.functions.json import json_text
from gridmeter.functions.requests import final_request, initial_request, memory_parts
from gridmeter.operators.joins import broadcast_if_small
from gridmeter.operators.reports import task_rollup
from gridmeter.sources.tables import Tables, normalize

def task_rel_usable(task_rel: DataFrame) -> DataFrame:
    """Task types whose memory request is not a parameter expression.

    A missing or JSON-null memory gives NULL and is dropped as well.
    """
    return task_rel.where(~json_text("requirements", "memory").like(PARAMETER_PREFIX + "%"))


def completed(search: DataFrame) -> DataFrame:
    """Completed tasks.  On a byte-string status the comparison is made on the
    bytes, so the filter is pushed into the Parquet scan (a decoded
    comparison could not be)."""
    if isinstance(search.schema["task_status"].dataType, T.BinaryType):
        return search.where(F.col("task_status") == F.lit(bytearray(COMPLETE_STATUS.encode())))
    return search.where(F.col("task_status") == COMPLETE_STATUS)


def usage_from_tables(tables: Tables, *, dataset: str | None = None, name: str | None = None,
                      limit: int | None = None, normalized: bool = False,
                      strict: bool = False, rollup: DataFrame | None = None,
                      counts: Observation | None = None) -> DataFrame:
    """One row per completed task with outputs (see module doc for the plan).

    `rollup` gives the figures of `task_rollup` from elsewhere (say, the stored states of
    `operators.rollup_store`), so that no report is read.  `counts` gets the numbers of
    reports that cannot be read, by reason, when the result is computed.

    `dataset` / `name` / `limit` make a debugging slice: the tasks whose search
    row has that dataset id and name, the first `limit` of them by task_id.  The
    slice is taken before the joins, so `task_stat` is reduced to its tasks
    before any report is parsed; it may give fewer rows than `limit`, as tasks
    without outputs drop out later.  `strict` raises at run time on a report that
    cannot be read (see `report_problems`, which lists them otherwise).
    """
    t = tables if normalized else normalize(tables)
    search = completed(tables.search)
    if dataset is not None or name is not None or limit is not None:
        chosen = t.search
        if dataset is not None:
            chosen = chosen.where(F.col("dataset_id") == dataset)
        if name is not None:
            chosen = chosen.where(F.col("name") == name)
        chosen = chosen.select("task_id")
        if limit is not None:
            chosen = chosen.orderBy("task_id").limit(limit)
        search = search.join(chosen, "task_id", "left_semi")
        t = replace(t, task=t.task.join(chosen, "task_id", "left_semi"),
                    task_stat=t.task_stat.join(chosen, "task_id", "left_semi"))
        rollup = rollup.join(chosen, "task_id", "left_semi") if rollup is not None else None
    search = search.select("task_id", "job_id")

    rel = task_rel_usable(t.task_rel)
    rel = rel.select(
        "task_rel_id",
        id2num("dataset_id").alias("dataset_id"),
        "task_index",
        F.col("name").alias("task_name"),
        *[c.alias(k) for k, c in memory_parts("requirements", "rel").items()])

    task = t.task.select("task_id", "task_rel_id",
                         *[c.alias(k) for k, c in memory_parts("requirements", "task").items()])
    job = t.job.select("job_id", "job_index")

    rollup = task_rollup(t.task_stat, strict, counts) if rollup is None else rollup
    rollup = (rollup
              .where((F.col("n_ok") > 0) & F.col("has_output") & (F.col("output_size") > 0)))

    # task, search and the rollup join on task_id (one hash partitioning).
    # Task types (a few per dataset) are broadcast after a row-count check;
    # jobs grow with the data, so they join by shuffle and only AQE may
    # switch to a broadcast, from the measured size of the shuffled side.
    joined = (rollup.join(task, "task_id")
                    .join(search, "task_id")
                    .join(broadcast_if_small(rel),
                          "task_rel_id")
                    .join(job, "job_id"))
    return joined.select(
        "dataset_id", "task_index", "task_name", "job_index", "input_size", "output_size", "rss",
        "run_time",
        initial_request(F.col("rel_mem_present"), F.col("rel_mem")).alias("initial_rss_request"),
        final_request(F.col("task_mem_present"), F.col("task_mem"),
                      F.col("rel_mem_present"), F.col("rel_mem")).alias("final_rss_request"),
        "evictions", "mean_ttf", "failed_GB_hours", "input_duration", "output_duration",
        "time_finished", "task_id")
