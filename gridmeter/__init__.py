"""gridmeter: per-task resource-usage analytics for batch-computing records, on Spark.

Raw records (datasets, jobs, tasks and their nested JSON run reports) become
one flat, query-ready row per completed task.  Everything is expressed with
DataFrame / SQL built-ins so Catalyst plans it and Tungsten runs it.
"""

from gridmeter.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
