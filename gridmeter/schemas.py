"""Table schemas, report document shapes, keys and references.

Identifiers and short text columns are byte strings in the source tables;
`sources.tables.normalize` decodes the text ones at the scan.  JSON documents
stay strings until an operator parses them once with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

B, S, I, D = T.BinaryType(), T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(kinds: str, *names: str) -> T.StructType:
    """Fields that are all required; `kinds` has one letter a name: b bytes, s text,
    i integer, d double."""
    types = {"b": B, "s": S, "i": I, "d": D}
    return T.StructType([T.StructField(n, types[k], False) for n, k in zip(names, kinds, strict=True)])


# The six active tables, with every declared column.  Fixed values: names and
# types must equal the store's.
TABLES = {
    "dataset": _struct("bbbsbbbbiiibbssssib", "dataset_id", "name", "description", "gridspec",
                       "status", "username", "institution", "submit_host", "priority",
                       "jobs_submitted", "tasks_submitted", "start_date", "end_date",
                       "temporary_storage", "global_storage", "stat_keys", "categoryvalue_ids",
                       "debug", "groups_id"),
    "job": _struct("bbbib", "job_id", "dataset_id", "status", "job_index", "status_changed"),
    "task_rel": _struct("bbibss", "task_rel_id", "dataset_id", "task_index", "name", "depends",
                        "requirements"),
    "task": _struct("bbbbsbiiddissb", "task_id", "status", "prev_status", "status_changed",
                    "submit_dir", "grid_queue_id", "failures", "evictions", "walltime",
                    "walltime_err", "walltime_err_n", "depends", "requirements", "task_rel_id"),
    "search": _struct("bbbbbb", "task_id", "job_id", "dataset_id", "gridspec", "name",
                      "task_status"),
    "task_stat": _struct("bbs", "task_stat_id", "task_id", "stat"),
}

PRIMARY_KEYS = {
    "dataset": ["dataset_id"],
    "job": ["job_id"],
    "task_rel": ["task_rel_id"],
    "task": ["task_id"],
    "search": ["task_id"],
    "task_stat": ["task_stat_id"],
}

# (child, child column, parent, parent column)
REFERENCES = [
    ("search", "task_id", "task", "task_id"),
    ("search", "job_id", "job", "job_id"),
    ("search", "dataset_id", "dataset", "dataset_id"),
    ("task_rel", "dataset_id", "dataset", "dataset_id"),
    ("task", "task_rel_id", "task_rel", "task_rel_id"),
    ("task_stat", "task_id", "task", "task_id"),
]

# Columns declared with DEFAULT '0'.
DEFAULT_ZERO = {
    "dataset": ["priority", "jobs_submitted", "tasks_submitted", "debug"],
    "job": ["job_index"],
    "task_rel": ["task_index"],
    "task": ["failures", "evictions", "walltime", "walltime_err", "walltime_err_n"],
}

# Text columns stored as bytes that the queries read as text.
TEXT_COLUMNS = {
    "dataset": ["dataset_id", "name", "status"],
    "job": ["status"],
    "task_rel": ["dataset_id", "name"],
    "task": ["status"],
    "search": ["dataset_id", "name", "task_status"],
}

# One transfer record inside a report.  Scalars are read as their JSON text and
# cast where used, the way a JSON path text extraction followed by a cast works.
TRANSFER = "STRUCT<size: STRING, duration: STRING, error: STRING>"
TASK_STATS = f"STRUCT<download: ARRAY<{TRANSFER}>, upload: ARRAY<{TRANSFER}>>"

# Document path: `error` is kept as a VARIANT so its JSON token type survives
# (the string "false" is truthy, the boolean false is not).
TRANSFER_DOC = "STRUCT<size: STRING, duration: STRING, error: VARIANT>"
TASK_STATS_DOC = f"STRUCT<download: ARRAY<{TRANSFER_DOC}>, upload: ARRAY<{TRANSFER_DOC}>>"

# A report as stored in task_stat.stat (table path).  A `task_stats` held as a
# JSON string does not match the struct and reads as NULL, i.e. no transfers.
REPORT = ("error STRING, error_summary STRING, time STRING, "
          "resources STRUCT<memory: STRING, time: STRING>, "
          f"task_stats {TASK_STATS}")

# A report as returned by the report listing (document path): resources is an
# open key set, task_stats may be an object or a string holding JSON; reading
# it as STRING yields the same JSON text for both encodings.
# (The document path never reads a report's own `error` value, so it is not
# parsed.)
REPORT_STATS = ("error_summary STRING, site STRING, hostname STRING, "
                "time STRING, resources MAP<STRING, STRING>, task_stats STRING")
REPORT_DOC = f"MAP<STRING, STRUCT<stats: STRUCT<{REPORT_STATS}>>>"

# Landed listing documents: an object keyed by id, one or many keys per line.
DATASET_DOC = "MAP<STRING, STRUCT<dataset: BIGINT, dataset_id: STRING>>"
TASK_DOC = ("MAP<STRING, STRUCT<dataset_id: STRING, job_id: STRING, task_id: STRING, "
            "task_index: INT, requirements: MAP<STRING, STRING>, status: STRING>>")
JOB_DOC = "MAP<STRING, STRUCT<job_index: INT>>"

# A record may carry its landing order (`landed_at`, any increasing number).
LANDED = {
    "datasets": "doc STRING, landed_at BIGINT",
    "tasks": "dataset_id STRING, doc STRING, landed_at BIGINT",
    "jobs": "dataset_id STRING, doc STRING, landed_at BIGINT",
    "reports": "dataset_id STRING, task_id STRING, doc STRING, landed_at BIGINT",
    "configs": "dataset_id STRING, doc STRING, landed_at BIGINT",
}
CORRUPT = "_corrupt"      # text of a landed line that is not JSON
