"""Per-task usage from landed report documents (document path).

    tasks (status = complete at the scan)
      JOIN jobs     ON (dataset_id, job_id)   -- a task whose job is missing goes to
                                                diagnostics (strict: raise)
      LEFT JOIN per-task report figures ON (dataset_id, task_id)
      JOIN datasets ON dataset_id              -- small listing, broadcast after a
                                                row-count check
    -> <key>_req columns (os dropped), <key>_used columns of the final report

Report figures are computed inside each task's row (see
operators.documents): no shuffle on the report side except the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmeter.constants import DROPPED_REQUIREMENT
from gridmeter.operators.documents import task_figures, used_resources
from gridmeter.operators.joins import broadcast_if_small
from gridmeter.operators.pivot import discover_keys_of, flatten_map

INDEX = ["dataset", "task", "job"]
FIGURES = ["time_finished", "mem_wastage", "site", "hostname", "input_size", "input_duration",
           "output_size", "output_duration"]


def missing_jobs(tasks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Tasks whose job is not in their dataset's job listing."""
    return (tasks.join(jobs.select("dataset_id", "job_id"), ["dataset_id", "job_id"], "left_anti")
                 .select("dataset_id", "task_id", "job_id",
                         F.lit("missing_job").alias("reason")))


def task_rows(datasets: DataFrame, jobs: DataFrame, tasks: DataFrame, reports: DataFrame, *,
              strict: bool = False, split_above: int | None = None) -> DataFrame:
    """Every listed completed task with its job index (NULL when the job is
    missing; `has_job` false), requirements map and report figures.

    Counting these rows per dataset gives the harvest tally without
    re-reading the listings; `finish_usage` turns them into usage rows.
    """
    t = tasks.select("dataset_id", "task_id", "job_id", "task_index", "requirements")
    j = jobs.select("dataset_id", "job_id", "job_index", F.lit(True).alias("has_job"))
    tj = (t.join(j, ["dataset_id", "job_id"], "left")
           .withColumn("has_job", F.coalesce(F.col("has_job"), F.lit(False))))
    if strict:
        # The flag itself raises, so no filter on it can drop the row first.
        tj = tj.withColumn("has_job", F.when(F.col("has_job"), True).otherwise(
            F.raise_error(F.concat(F.lit("task without job: "), F.col("task_id"))).cast("boolean")))
    fig = task_figures(reports, split_above)
    if strict:
        fig = fig.withColumn("_chk", F.when(F.col("unreadable"), F.raise_error(
            F.concat(F.lit("unreadable report in task "), F.col("task_id")))))
        fig = fig.where(F.col("_chk").isNull()).drop("_chk")
    # Only strict mode reads these; dropping them here keeps them out of a
    # materialised table (where they would otherwise be computed).
    fig = fig.drop("unreadable", "n_reports")
    ds = broadcast_if_small(datasets.select("dataset_id", "dataset"))
    return (tj.join(fig, ["dataset_id", "task_id"], "left")
              .join(ds, "dataset_id")
              .withColumn("mem_wastage", F.coalesce("mem_wastage", F.lit(0.0))))


def finish_usage(rows: DataFrame, *, req_keys=None, used_keys=None,
                 keep_task_id: bool = False) -> DataFrame:
    """Usage rows from `task_rows`: tasks with a job, open maps flattened
    (`req_keys`, `used_keys`: see operators.pivot.flatten_map)."""
    x = rows.where(F.col("has_job"))
    if req_keys is None and used_keys is None:
        found = discover_keys_of({c: x.select(c) for c in ("requirements", "used")})
        req_keys, used_keys = found["requirements"], found["used"]
    x = flatten_map(x, "requirements", "_req", keys=req_keys, drop=(DROPPED_REQUIREMENT,))
    x = flatten_map(x, "used", "_used", keys=used_keys)
    lead = [F.col("dataset"), F.col("task_index").alias("task"), F.col("job_index").alias("job")]
    skip = {"dataset", "task_index", "job_index", "dataset_id", "job_id", "n_reports",
            "unreadable", "has_job"}
    if not keep_task_id:
        skip.add("task_id")
    rest = [c for c in x.columns if c not in skip]
    return x.select(*lead, *rest)


def usage_from_reports(datasets: DataFrame, jobs: DataFrame, tasks: DataFrame,
                       reports: DataFrame, *, req_keys=None, used_keys=None, strict: bool = False,
                       keep_task_id: bool = False, split_above: int | None = None) -> DataFrame:
    """One usage row per completed task of the listed datasets.

    `datasets`, `jobs`, `tasks` are the scanned listings (sources.landed);
    `reports` has (dataset_id, task_id, doc).  Key lists for the
    requirement/resource columns are discovered when not given, from the two
    maps straight from the scans (nothing is written; a key that only tasks
    without a job have gives a column of NULLs).
    `strict=True` raises at run time when a task's job is missing or one of
    its reports cannot be read (instead of leaving the task out / reading
    NULL and listing the report in `report_diagnostics`).  `split_above`: see
    `operators.documents.task_figures`.
    """
    rows = task_rows(datasets, jobs, tasks, reports, strict=strict, split_above=split_above)
    if req_keys is None and used_keys is None:
        found = discover_keys_of({"requirements": tasks.select("requirements"),
                                  "used": used_resources(reports)})
        req_keys, used_keys = found["requirements"], found["used"]
    return finish_usage(rows, req_keys=req_keys, used_keys=used_keys,
                        keep_task_id=keep_task_id)


def sort_for_write(usage: DataFrame) -> DataFrame:
    """O1: rows ordered by (dataset, task, job) across output files.

    Range partitioning on the whole index (not on `dataset` alone) lets a
    dataset holding a large share of all rows spread over many write tasks;
    each task sorts only its own range.
    """
    return usage.repartitionByRange(*INDEX).sortWithinPartitions(*INDEX)
