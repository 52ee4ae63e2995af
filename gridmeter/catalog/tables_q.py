"""Queries of the table path: scans, filters, joins, report aggregates, C1."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridmeter.catalog import query
from gridmeter.oracle import id2num as duck_id2num
from gridmeter.oracle import r6, with_views
from gridmeter.operators.reports import task_rollup
from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.session import scratch_path
from gridmeter.sources.derived import table_views
from gridmeter.sources.tables import normalize

# Relational form of the per-task report figures, shared by several oracles.
_ROLLUP_CTES = """
ok AS (SELECT task_id, max(memory) AS rss, max(ts) AS time_finished
       FROM ev WHERE error IS NULL GROUP BY task_id),
evict AS (SELECT task_id, count(*) AS evictions, avg(hours) AS mean_ttf,
                 sum(hours * memory) AS failed_GB_hours
          FROM ev WHERE overuse GROUP BY task_id),
runt AS (SELECT task_id, sum(hours) AS run_time FROM ev WHERE error IS NOT TRUE GROUP BY task_id),
per_report AS (SELECT task_id, task_stat_id, kind, sum(size) AS s, sum(duration) AS d
               FROM xfer WHERE error IS FALSE AND NOT stats_as_string
               GROUP BY task_id, task_stat_id, kind),
picked AS (SELECT task_id, kind, CAST(s AS DOUBLE) / 1073741824.0 AS gib, d / 3600.0 AS hrs
           FROM (SELECT *, row_number() OVER (PARTITION BY task_id, kind
                                              ORDER BY task_stat_id) AS rn FROM per_report)
           WHERE rn = 1)
"""


def _rollup_sql(select: str) -> str:
    return with_views(select, "ev", "xfer", "tk", "rel", "jb", extra=_ROLLUP_CTES)


_USAGE_SELECT = f"""
SELECT {duck_id2num('rel.dataset_id')} AS dataset_id, rel.task_index, rel.task_name, jb.job_index,
       {r6('i.gib')} AS input_size, {r6('o.gib')} AS output_size, {r6('ok.rss')} AS rss,
       {r6('runt.run_time')} AS run_time,
       CAST(rel.p_size AS DOUBLE) AS initial_rss_request,
       CASE tk.req_kind WHEN 0 THEN CAST(tk.task_id % 16 AS DOUBLE) WHEN 1 THEN NULL
            ELSE CAST(rel.p_size AS DOUBLE) END AS final_rss_request,
       evict.evictions, {r6('evict.mean_ttf')} AS mean_ttf,
       {r6('evict.failed_GB_hours')} AS failed_GB_hours,
       {r6('i.hrs')} AS input_duration, {r6('o.hrs')} AS output_duration,
       ok.time_finished, tk.task_id
FROM tk
JOIN rel ON rel.task_rel_id = tk.task_rel_id AND rel.req_kind >= 2
JOIN jb ON jb.job_id = tk.job_id
JOIN ok ON ok.task_id = tk.task_id
JOIN picked o ON o.task_id = tk.task_id AND o.kind = 'upload'
LEFT JOIN picked i ON i.task_id = tk.task_id AND i.kind = 'download'
LEFT JOIN evict ON evict.task_id = tk.task_id
LEFT JOIN runt ON runt.task_id = tk.task_id
WHERE tk.o_orderstatus = 'F' AND o.gib > 0
"""


@query("usage_from_tables", _rollup_sql(_USAGE_SELECT))
def q_usage_from_tables(spark, sf_dir):
    """One flat usage row per completed task with outputs."""
    return usage_from_tables(table_views(spark, sf_dir))


@query("usage_incremental", _rollup_sql(_USAGE_SELECT))
def q_usage_incremental(spark, sf_dir):
    """Reports come in three batches, each parsed once when it comes (most tasks
    have reports in all three), with a compaction between; the usage rows are those
    of all reports at once."""
    from gridmeter.operators.rollup_store import RollupStore
    tables = table_views(spark, sf_dir)
    store = RollupStore(spark, scratch_path(spark, f"rollup-{uuid.uuid4().hex[:12]}"))
    stats = normalize(tables).task_stat
    for batch in range(3):
        store.add(stats.where(F.col("task_stat_id") % 3 == batch), str(batch))
        if batch == 1:
            store.compact()
    return usage_from_tables(tables, rollup=store.rollup())


@query("usage_bucketed", _rollup_sql(_USAGE_SELECT))
def q_usage_bucketed(spark, sf_dir):
    """The tables stored bucketed by task and opened again; the same usage rows, with
    no shuffle of tasks, searches or reports."""
    from gridmeter.sources.bucketed import open_tables, store_tables
    path = scratch_path(spark, f"bucketed-{uuid.uuid4().hex[:12]}")
    store_tables(table_views(spark, sf_dir), path, 16)
    return usage_from_tables(open_tables(spark, path, 16))


@query("output_totals", _rollup_sql(f"""
SELECT task_id, {r6('gib')} AS output_size, {r6('hrs')} AS output_duration
FROM picked WHERE kind = 'upload'
"""))
def q_output_totals(spark, sf_dir):
    """Upload totals of the smallest report with a good upload."""
    r = task_rollup(normalize(table_views(spark, sf_dir)).task_stat)
    return r.where("has_output").select("task_id", "output_size", "output_duration")


@query("input_totals", _rollup_sql(f"""
SELECT task_id, {r6('gib')} AS input_size, {r6('hrs')} AS input_duration
FROM picked WHERE kind = 'download'
"""))
def q_input_totals(spark, sf_dir):
    """Download totals of the smallest report with a good download."""
    r = task_rollup(normalize(table_views(spark, sf_dir)).task_stat)
    return r.where("has_input").select("task_id", "input_size", "input_duration")


def _views(spark, sf_dir):
    return normalize(table_views(spark, sf_dir))


# Source table and columns of each derived table.
_DERIVED = {
    "dataset": ("nation", ["dataset_id", "name"]),
    "job": ("customer", ["job_id", "dataset_id", "status", "job_index"]),
    "task_rel": ("part", ["task_rel_id", "dataset_id", "task_index", "name", "requirements"]),
    "task": ("orders", ["task_id", "status", "requirements", "task_rel_id"]),
    "search": ("orders", ["task_id", "job_id", "dataset_id", "name", "task_status"]),
    "task_stat": ("events", ["task_stat_id", "task_id", "stat"]),
}


@query("scan_tables", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) AS n_values FROM {src}"
    for t, (src, columns) in _DERIVED.items() for c in columns))
def q_scan_tables(spark, sf_dir):
    """Scan of the six tables, rows and values per column."""
    from gridmeter.sources.tables import scan_counts
    return scan_counts(_views(spark, sf_dir)).withColumnRenamed("table", "table_name")


@query("report_problems", with_views("""
SELECT task_stat_id, task_id, reason FROM (
  SELECT ev.task_stat_id, ev.task_id,
         CASE WHEN ev.event_id % 17 = 1 THEN 'unparseable_report'
              WHEN ev.event_id % 17 = 6 THEN 'bad_error_value'
              WHEN ev.event_id % 17 = 5 AND has_resources THEN 'bad_resources'
              WHEN ev.event_id % 17 = 7 THEN 'bad_time'
              WHEN ev.event_id % 17 = 8 AND x.n_error > 0 THEN 'bad_transfer_error'
              WHEN ev.event_id % 17 IN (3, 4) AND x.n_good > 0 THEN 'bad_transfer_value' END AS reason
  FROM ev LEFT JOIN (SELECT task_stat_id, count(*) FILTER (WHERE error IS NOT NULL) AS n_error,
                            count(*) FILTER (WHERE error IS FALSE) AS n_good
                     FROM xfer WHERE NOT stats_as_string GROUP BY 1) x ON x.task_stat_id = ev.task_stat_id)
WHERE reason IS NOT NULL
""", "ev", "xfer"))
def q_report_problems(spark, sf_dir):
    """Reports of the table path that cannot be read, with a reason (six kinds of flaw)."""
    from gridmeter.operators.reports import report_problems
    from gridmeter.sources.derived import flawed_stats
    return report_problems(flawed_stats(_views(spark, sf_dir).task_stat))


@query("report_parse", with_views(f"""
SELECT task_stat_id, task_id, error, has_summary AS has_error_summary, overuse,
       {r6('memory')} AS memory, {r6('hours')} AS hours, ts AS finished
FROM ev
""", "ev"))
def q_report_parse(spark, sf_dir):
    """Each report parsed once into typed fields."""
    from gridmeter.operators.reports import OVERUSE_PREFIX, parse_reports
    r = parse_reports(_views(spark, sf_dir).task_stat)
    return r.select("task_stat_id", "task_id", F.col("error_flag").alias("error"),
                    F.col("error_summary").isNotNull().alias("has_error_summary"),
                    F.coalesce(F.col("error_summary").startswith(OVERUSE_PREFIX),
                               F.lit(False)).alias("overuse"),
                    "memory", "hours", "finished")


@query("transfers_explode", with_views(f"""
SELECT task_stat_id, task_id, kind, size, {r6('duration')} AS duration, error
FROM xfer WHERE NOT stats_as_string
""", "xfer"))
def q_transfers_explode(spark, sf_dir):
    """Transfer arrays exploded; a missing array (or one held in a
    string on the table path) gives no rows."""
    from gridmeter.operators.reports import explode_transfers
    return explode_transfers(_views(spark, sf_dir).task_stat)


@query("transfers_ok_strict", with_views(f"""
SELECT task_stat_id, kind, size, {r6('duration')} AS duration
FROM xfer WHERE error IS FALSE AND NOT stats_as_string
""", "xfer"))
def q_transfers_ok_strict(spark, sf_dir):
    """good transfers of the table path: error literally false."""
    from gridmeter.operators.reports import explode_transfers
    t = explode_transfers(_views(spark, sf_dir).task_stat)
    return t.where(F.col("error").eqNullSafe(F.lit(False))).select(
        "task_stat_id", "kind", "size", "duration")


@query("json_path_text", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
""")
def q_json_path_text(spark, sf_dir):
    """Text at a JSON path, then a cast."""
    from gridmeter.functions.json import json_text
    from gridmeter.sources.derived import load
    e = load(spark, sf_dir, "events")
    return e.select("event_id", json_text("props", "k").alias("k_text"),
                    json_text("props", "k").cast("bigint").alias("k"))


@query("json_key_present", with_views("""
SELECT task_id, req_kind IN (0, 1) AS memory_present,
       CASE WHEN req_kind = 0 THEN CAST(task_id % 16 AS DOUBLE) END AS memory
FROM tk
""", "tk"))
def q_json_key_present(spark, sf_dir):
    """X11: key presence (a key holding null is present) vs its value."""
    from gridmeter.functions.requests import memory_parts
    m = memory_parts("requirements", "t")
    return _views(spark, sf_dir).task.select(
        "task_id", m["t_mem_present"].alias("memory_present"), m["t_mem"].alias("memory"))


@query("filter_complete", """
SELECT o_orderkey AS task_id, o_custkey AS job_id FROM orders WHERE o_orderstatus = 'F'
""")
def q_filter_complete(spark, sf_dir):
    """completed tasks (status decoded from bytes, filter in the scan)."""
    from gridmeter.plans.usage_tables import completed
    return completed(_views(spark, sf_dir).search).select("task_id", "job_id")


@query("filter_parameterised", with_views("""
SELECT task_rel_id, CAST(p_size AS DOUBLE) AS memory FROM rel WHERE req_kind >= 2
""", "rel"))
def q_filter_parameterised(spark, sf_dir):
    """drop task types whose memory is an expression, or missing/null."""
    from gridmeter.functions.json import json_text
    from gridmeter.plans.usage_tables import task_rel_usable
    rel = task_rel_usable(_views(spark, sf_dir).task_rel)
    return rel.select("task_rel_id",
                      json_text("requirements", "memory").cast("double").alias("memory"))


def _numeric_named(spark, sf_dir):
    from gridmeter.sources.derived import load
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", F.when(F.col("p_partkey") % 10 == 0,
                                        (F.col("p_partkey") % 6).cast("string"))
                    .otherwise(F.col("p_type")).alias("name"))


_NUMERIC_NAMED = """named AS (
  SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN CAST(p_partkey % 6 AS VARCHAR)
                         ELSE p_type END AS name FROM part)"""


@query("filter_numeric_name", f"""
WITH {_NUMERIC_NAMED}
SELECT p_partkey, name FROM named
WHERE try_cast(name AS DOUBLE) IS NULL OR try_cast(name AS DOUBLE) > 3
""")
def q_filter_numeric_name(spark, sf_dir):
    """`name > 3` where numeric names compare as numbers and text passes."""
    from gridmeter.functions.text import name_above
    return _numeric_named(spark, sf_dir).where(name_above("name", 3))


@query("filter_resource_reports", with_views("""
SELECT task_stat_id FROM ev WHERE has_resources
""", "ev"))
def q_filter_resource_reports(spark, sf_dir):
    """Reports worth copying: longer than 8 and mentioning resources
    (case-insensitive, like the source store's LIKE)."""
    from gridmeter.operators.copy import resource_reports
    return resource_reports(_views(spark, sf_dir).task_stat).select("task_stat_id")


@query("join_task_rel", with_views("""
SELECT tk.task_id, tk.task_rel_id, rel.dataset_id, rel.task_index, rel.task_name
FROM tk JOIN rel ON rel.task_rel_id = tk.task_rel_id WHERE rel.req_kind >= 2
""", "tk", "rel"))
def q_join_task_rel(spark, sf_dir):
    """Task x usable task type (N:1)."""
    from gridmeter.plans.usage_tables import task_rel_usable
    v = _views(spark, sf_dir)
    rel = task_rel_usable(v.task_rel).select("task_rel_id", "dataset_id", "task_index",
                                              F.col("name").alias("task_name"))
    return v.task.select("task_id", "task_rel_id").join(rel, "task_rel_id")


_REQUESTS = """
       CASE WHEN rel.req_kind = 0 THEN NULL WHEN rel.req_kind = 1 THEN 2.0
            ELSE CAST(rel.p_size AS DOUBLE) END AS initial_rss_request,
       CASE WHEN tk.req_kind = 0 THEN CAST(tk.task_id % 16 AS DOUBLE)
            WHEN tk.req_kind = 1 THEN NULL
            WHEN rel.req_kind = 0 THEN NULL WHEN rel.req_kind = 1 THEN 2.0
            ELSE CAST(rel.p_size AS DOUBLE) END AS final_rss_request"""


def _requests(v, usable_only):
    from gridmeter.functions.requests import final_request, initial_request, memory_parts
    from gridmeter.plans.usage_tables import task_rel_usable
    rel = task_rel_usable(v.task_rel) if usable_only else v.task_rel
    rel = rel.select("task_rel_id", *[c.alias(k) for k, c in
                                      memory_parts("requirements", "rel").items()])
    task = v.task.select("task_id", "task_rel_id", *[c.alias(k) for k, c in
                                                     memory_parts("requirements", "task").items()])
    j = task.join(rel, "task_rel_id")
    return j.select(
        "task_id",
        initial_request(F.col("rel_mem_present"), F.col("rel_mem")).alias("initial_rss_request"),
        final_request(F.col("task_mem_present"), F.col("task_mem"), F.col("rel_mem_present"),
                      F.col("rel_mem")).alias("final_rss_request"))


@query("join_search", with_views(f"""
SELECT tk.task_id, tk.job_id, {_REQUESTS}
FROM tk JOIN rel ON rel.task_rel_id = tk.task_rel_id
WHERE rel.req_kind >= 2 AND tk.o_orderstatus = 'F'
""", "tk", "rel"))
def q_join_search(spark, sf_dir):
    """X completed search rows (1:1), request columns from both sides."""
    from gridmeter.plans.usage_tables import completed
    v = _views(spark, sf_dir)
    s = completed(v.search).select("task_id", "job_id")
    return _requests(v, True).join(s, "task_id")


@query("join_job", with_views("""
SELECT tk.task_id, jb.job_index FROM tk JOIN jb ON jb.job_id = tk.job_id
WHERE tk.o_orderstatus = 'F'
""", "tk", "jb"))
def q_join_job(spark, sf_dir):
    """Completed task -> its job (N:1)."""
    from gridmeter.plans.usage_tables import completed
    v = _views(spark, sf_dir)
    s = completed(v.search).select("task_id", "job_id")
    return s.join(v.job.select("job_id", "job_index"), "job_id").select("task_id", "job_index")


@query("memory_request", with_views(f"""
SELECT tk.task_id, {_REQUESTS}
FROM tk JOIN rel ON rel.task_rel_id = tk.task_rel_id
""", "tk", "rel"))
def q_memory_request(spark, sf_dir):
    """Initial and final memory requests for every task (the
    2.0 fallback is reachable here; a present-but-null key gives NULL)."""
    return _requests(_views(spark, sf_dir), False)


@query("default_requirements", with_views("""
SELECT task_rel_id, CAST(10.0 AS DOUBLE) AS disk,
       CASE WHEN req_kind >= 2 THEN CAST(p_size AS DOUBLE) ELSE 2.0 END AS memory,
       CAST(1.0 AS DOUBLE) AS cpu, CAST(0.0 AS DOUBLE) AS gpu, CAST(1.0 AS DOUBLE) AS time
FROM rel
""", "rel"))
def q_default_requirements(spark, sf_dir):
    """Requirement columns filled from the documented defaults."""
    from gridmeter.functions.requests import with_default_requirements
    rel = with_default_requirements(_views(spark, sf_dir).task_rel)
    return rel.select("task_rel_id", "disk", "memory", "cpu", "gpu", "time")


@query("decode_bytes", "SELECT p_partkey AS task_rel_id, p_type AS task_name FROM part")
def q_decode_bytes(spark, sf_dir):
    """Byte-string names decoded to text at the scan."""
    return _views(spark, sf_dir).task_rel.select("task_rel_id", F.col("name").alias("task_name"))


@query("peak_usage", _rollup_sql(f"""
SELECT task_id, {r6('rss')} AS rss, time_finished FROM ok
"""))
def q_peak_usage(spark, sf_dir):
    """Peak memory and last finish over successful reports;
    tasks without a successful report have no row."""
    r = task_rollup(_views(spark, sf_dir).task_stat)
    return r.where("n_ok > 0").select("task_id", "rss", "time_finished")


@query("run_time", _rollup_sql(f"""
SELECT task_id, {r6('run_time')} AS run_time FROM runt
"""))
def q_run_time(spark, sf_dir):
    """Hours summed over reports whose error is not true."""
    r = task_rollup(_views(spark, sf_dir).task_stat)
    return r.where("n_run > 0").select("task_id", "run_time")


@query("overuse_summary", _rollup_sql(f"""
SELECT task_id, evictions, {r6('mean_ttf')} AS mean_ttf,
       {r6('failed_GB_hours')} AS failed_GB_hours FROM evict
"""))
def q_overuse_summary(spark, sf_dir):
    """Count, mean hours and GB-hours of memory-overuse reports."""
    r = task_rollup(_views(spark, sf_dir).task_stat)
    return r.where(F.col("evictions").isNotNull()).select(
        "task_id", "evictions", "mean_ttf", "failed_GB_hours")


@query("task_rollup", _rollup_sql(f"""
SELECT t.task_id, coalesce(n.n_ok, 0) AS n_ok, {r6('ok.rss')} AS rss, ok.time_finished,
       evict.evictions, {r6('evict.mean_ttf')} AS mean_ttf,
       {r6('evict.failed_GB_hours')} AS failed_GB_hours, {r6('runt.run_time')} AS run_time,
       {r6('i.gib')} AS input_size, {r6('i.hrs')} AS input_duration,
       {r6('o.gib')} AS output_size, {r6('o.hrs')} AS output_duration
FROM (SELECT DISTINCT task_id FROM ev) t
LEFT JOIN (SELECT task_id, count(*) AS n_ok FROM ev WHERE error IS NULL GROUP BY task_id) n
       ON n.task_id = t.task_id
LEFT JOIN ok ON ok.task_id = t.task_id
LEFT JOIN evict ON evict.task_id = t.task_id
LEFT JOIN runt ON runt.task_id = t.task_id
LEFT JOIN picked i ON i.task_id = t.task_id AND i.kind = 'download'
LEFT JOIN picked o ON o.task_id = t.task_id AND o.kind = 'upload'
"""))
def q_task_rollup(spark, sf_dir):
    """A10: every per-task report figure from one groupBy(task_id)."""
    r = task_rollup(_views(spark, sf_dir).task_stat)
    return r.select("task_id", "n_ok", "rss", "time_finished", "evictions", "mean_ttf",
                    "failed_GB_hours", "run_time", "input_size", "input_duration",
                    "output_size", "output_duration")


@query("usage_slice", _rollup_sql(_USAGE_SELECT + """
  AND tk.task_id IN (SELECT o_orderkey FROM orders
                     WHERE (o_orderkey % 200) % 25 = 2 AND o_orderpriority = '2-HIGH'
                     ORDER BY o_orderkey LIMIT 10)
"""))
def q_usage_slice(spark, sf_dir):
    """The debugging slice: the first ten tasks of one dataset and search name."""
    return usage_from_tables(table_views(spark, sf_dir), dataset="2", name="2-HIGH", limit=10)
