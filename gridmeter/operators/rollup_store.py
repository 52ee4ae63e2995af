"""Stored rollup states: new reports are merged into what is known of their tasks.

Every batch of reports becomes one folder of per-task states (the aggregates of
`operators.reports.STATE`), parsed once when it comes.  The figures of all tasks are
one aggregate over the stored states: narrow fixed-width rows, no JSON.  `compact`
merges the folders into one, so that reading does not slow down with their number.

  <path>/states/<folder>   states of a batch, or of all batches up to a compaction
  <path>/log               folder, place, base: what counts, appended to last

A folder counts once the log names it, so a lost write or compaction leaves the store
as it was.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridmeter.operators.reports import merge_states, state_figures, task_states
from gridmeter.sources.sinks import read_table

LOG = T.StructType([T.StructField("folder", T.StringType()), T.StructField("place", T.LongType()),
                    T.StructField("base", T.BooleanType())])


class RollupStore:
    """Rollup states under `path`.  Every report must come in one batch only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> list:
        """Log rows in order: one per batch and compaction."""
        log = read_table(self.spark, f"{self.path}/log", LOG)
        return sorted(log.collect(), key=lambda r: r["place"]) if log is not None else []

    def _append(self, folder: str, place: int, base: bool) -> None:
        self.spark.createDataFrame([(folder, place, base)], LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def folders(self) -> list[str]:
        """The folders that count: the last compaction and the batches since."""
        out: list[str] = []
        for r in self._log():
            out = [r["folder"]] if r["base"] else [*out, r["folder"]]
        return out

    def add(self, task_stat: DataFrame, batch: str, strict: bool = False) -> bool:
        """Take a batch of reports; False, and nothing done, if a batch of that name is there."""
        log = self._log()
        if any(r["folder"] == f"batch-{batch}" for r in log):
            return False
        task_states(task_stat, strict).write.mode("overwrite").parquet(f"{self.path}/states/batch-{batch}")
        self._append(f"batch-{batch}", len(log), False)
        return True

    def states(self) -> DataFrame | None:
        """One state per task; None before the first batch."""
        folders = self.folders()
        if not folders:
            return None
        stored = self.spark.read.parquet(*[f"{self.path}/states/{f}" for f in folders])
        return merge_states(stored) if len(folders) > 1 else stored

    def rollup(self) -> DataFrame | None:
        """The columns of `task_rollup`, without reading a report."""
        states = self.states()
        return state_figures(states) if states is not None else None

    def compact(self) -> None:
        """Merge all folders into one; the next reads take that."""
        if len(self.folders()) > 1:
            place = len(self._log())
            self.states().write.mode("overwrite").parquet(f"{self.path}/states/base-{place}")
            self._append(f"base-{place}", place, True)
