"""Queries of the document path: landed listings and report documents, C2."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridmeter.catalog import query
from gridmeter.oracle import r6, with_views
from gridmeter.operators import documents as docs
from gridmeter.plans.usage_reports import usage_from_reports
from gridmeter.sources import landed
from gridmeter.session import drop_path, materialize, scratch_path
from gridmeter.sources.derived import flawed_reports, landed_documents


def _scanned(spark, sf_dir):
    raw = landed_documents(spark, sf_dir)
    return {
        "datasets": landed.scan_datasets(raw["datasets"]),
        "jobs": landed.scan_jobs(raw["jobs"]),
        "tasks": landed.scan_tasks(raw["tasks"]),
        "all_tasks": landed.scan_tasks(raw["tasks"], status=None),
        "reports": landed.scan_reports(raw["reports"]),
    }


# Relational form of the document-path figures.
_DOC_CTES = """
fin AS (SELECT task_id, ts, memory, hours, cpu, node FROM (
          SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ts DESC, ord) AS rn
          FROM evo WHERE has_resources) WHERE rn = 1),
waste AS (SELECT task_id, sum(memory * hours) AS w FROM evo WHERE overuse AND has_resources
          GROUP BY task_id),
lastr AS (SELECT task_id, site, hostname FROM (
            SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY ord DESC) AS rn FROM evo)
          WHERE rn = 1),
xr AS (SELECT task_stat_id, kind, sum(size) AS s, sum(duration) AS d FROM xfer
       WHERE error IS NOT TRUE GROUP BY task_stat_id, kind),
cand AS (SELECT e.task_id, e.ord, x.kind, x.s, x.d FROM evo e
         JOIN xr x ON x.task_stat_id = e.task_stat_id WHERE NOT e.has_summary),
lastx AS (SELECT task_id, kind, CAST(s AS DOUBLE) / 1073741824.0 AS gib, d / 3600.0 AS hrs FROM (
            SELECT *, row_number() OVER (PARTITION BY task_id, kind ORDER BY ord DESC) AS rn
            FROM cand) WHERE rn = 1)
"""


def _doc_sql(select: str) -> str:
    return with_views(select, "evo", "xfer", "rt", extra=_DOC_CTES)


_REQ_COLS = """
       CASE WHEN rt.req_kind = 0 THEN CAST(rt.task_id % 16 AS DOUBLE)
            WHEN rt.req_kind = 2 THEN CAST(2.5 AS DOUBLE) END AS memory_req,
       CASE WHEN rt.req_kind = 0 THEN CAST(1.0 AS DOUBLE) END AS cpu_req,
       CASE WHEN rt.req_kind = 2 THEN CAST(1.0 AS DOUBLE) END AS gpu_req,
       CASE WHEN rt.req_kind = 1 THEN 'x86' END AS arch_req,
       CASE WHEN rt.req_kind = 0 THEN CAST(rt.task_id % 3 AS VARCHAR)
            WHEN rt.req_kind = 2 THEN 'long' END AS queue_req"""

_USAGE_SELECT = f"""
SELECT rt.dataset, rt.task_index AS task, rt.job_index AS job, {_REQ_COLS},
       fin.ts AS time_finished, {r6('fin.memory')} AS memory_used, {r6('fin.hours')} AS time_used,
       fin.cpu AS cpu_used, fin.node AS node_used, {r6('coalesce(waste.w, 0.0)')} AS mem_wastage,
       lastr.site, lastr.hostname,
       {r6('i.gib')} AS input_size, {r6('i.hrs')} AS input_duration,
       {r6('o.gib')} AS output_size, {r6('o.hrs')} AS output_duration
FROM rt
LEFT JOIN fin ON fin.task_id = rt.task_id
LEFT JOIN waste ON waste.task_id = rt.task_id
LEFT JOIN lastr ON lastr.task_id = rt.task_id
LEFT JOIN lastx i ON i.task_id = rt.task_id AND i.kind = 'download'
LEFT JOIN lastx o ON o.task_id = rt.task_id AND o.kind = 'upload'
WHERE rt.o_orderstatus = 'F'
"""


def _usage(spark, sf_dir):
    s = _scanned(spark, sf_dir)
    return usage_from_reports(s["datasets"], s["jobs"], s["tasks"], s["reports"])


@query("usage_from_reports", _doc_sql(_USAGE_SELECT))
def q_usage_from_reports(spark, sf_dir):
    """One usage row per completed task from landed documents."""
    return _usage(spark, sf_dir)


@query("usage_from_split_reports", _doc_sql(_USAGE_SELECT))
def q_usage_from_split_reports(spark, sf_dir):
    """The same rows with every document above 1,500 bytes split into its reports,
    whose figures are merged by position."""
    s = _scanned(spark, sf_dir)
    # Read three times (short documents, long ones, keys), so they land once.
    reports = materialize(s["reports"], "landed-reports")
    return usage_from_reports(s["datasets"], s["jobs"], s["tasks"], reports, split_above=1_500)


@query("usage_sorted", _doc_sql(_USAGE_SELECT))
def q_usage_sorted(spark, sf_dir):
    """O1: the same rows, grouped by dataset and sorted by (dataset, task, job)."""
    from gridmeter.plans.usage_reports import sort_for_write
    return sort_for_write(_usage(spark, sf_dir))


@query("report_explode", with_views("""
SELECT CAST(rt.dataset_id AS VARCHAR) AS dataset_id, CAST(rt.task_id AS VARCHAR) AS task_id,
       evo.ord, CAST(evo.event_id AS VARCHAR) AS stat_id
FROM rt LEFT JOIN evo ON evo.task_id = rt.task_id
""", "rt", "evo"))
def q_report_explode(spark, sf_dir):
    """Report documents to one row per report with its document position;
    a task without reports keeps a row (posexplode_outer)."""
    s = _scanned(spark, sf_dir)
    return docs.explode_reports(s["reports"]).select("dataset_id", "task_id", "ord", "stat_id")


@query("double_encoded_json", with_views("""
SELECT CAST(ev.event_id AS VARCHAR) AS stat_id,
       count(x.kind) FILTER (WHERE x.kind = 'download') AS n_download,
       count(x.kind) FILTER (WHERE x.kind = 'upload') AS n_upload
FROM ev LEFT JOIN xfer x ON x.task_stat_id = ev.event_id
WHERE ev.has_task_stats
GROUP BY ev.event_id
""", "ev", "xfer"))
def q_double_encoded_json(spark, sf_dir):
    """task_stats held as an object or as a string of JSON read alike."""
    from gridmeter.schemas import TASK_STATS
    e = docs.explode_reports(_scanned(spark, sf_dir)["reports"])
    e = e.where(F.col("stats.task_stats").isNotNull())
    ts = F.from_json(F.col("stats.task_stats"), TASK_STATS)
    empty = F.array().cast("array<struct<size:string,duration:string,error:string>>")
    return e.select("stat_id",
                    F.size(F.coalesce(ts["download"], empty)).cast("bigint").alias("n_download"),
                    F.size(F.coalesce(ts["upload"], empty)).cast("bigint").alias("n_upload"))


@query("transfers_ok_lenient", with_views(f"""
SELECT CAST(task_stat_id AS VARCHAR) AS stat_id, kind, size, {r6('duration')} AS duration
FROM xfer WHERE error IS NOT TRUE
""", "xfer"))
def q_transfers_ok_lenient(spark, sf_dir):
    """Good transfers of the document path: error not truthy, a
    missing error counts (string-encoded task_stats included)."""
    from gridmeter.functions.json import variant_truthy
    t = docs.explode_transfers(_scanned(spark, sf_dir)["reports"])
    return t.where(~variant_truthy("error")).select("stat_id", "kind", "size", "duration")


@query("final_report", _doc_sql(f"""
SELECT CAST(task_id AS VARCHAR) AS task_id, ts AS time_finished,
       {r6('memory')} AS memory_used, {r6('hours')} AS time_used FROM fin
"""))
def q_final_report(spark, sf_dir):
    """The latest report carrying resources, per task."""
    f = docs.task_figures(_scanned(spark, sf_dir)["reports"]).where(F.col("used").isNotNull())
    return f.select("task_id", "time_finished",
                    F.col("used")["memory"].try_cast("double").alias("memory_used"),
                    F.col("used")["time"].try_cast("double").alias("time_used"))


@query("resources_pivot", _doc_sql(f"""
SELECT CAST(task_id AS VARCHAR) AS task_id, {r6('memory')} AS memory_used,
       {r6('hours')} AS time_used, cpu AS cpu_used, node AS node_used FROM fin
"""))
def q_resources_pivot(spark, sf_dir):
    """P5: the final report's resources as `<key>_used` columns (keys discovered)."""
    from gridmeter.operators.pivot import flatten_map
    f = docs.task_figures(_scanned(spark, sf_dir)["reports"]).where(F.col("used").isNotNull())
    return flatten_map(f.select("task_id", "used"), "used", "_used")


@query("requirements_pivot", with_views(f"""
SELECT CAST(rt.task_id AS VARCHAR) AS task_id, {_REQ_COLS}
FROM rt WHERE rt.o_orderstatus = 'F'
""", "rt"))
def q_requirements_pivot(spark, sf_dir):
    """Requirements as `<key>_req` columns; `os` dropped."""
    from gridmeter.operators.pivot import flatten_map
    t = _scanned(spark, sf_dir)["tasks"].select("task_id", "requirements")
    return flatten_map(t, "requirements", "_req", drop=("os",))


@query("mem_wastage", _doc_sql(f"""
SELECT CAST(rt.task_id AS VARCHAR) AS task_id, {r6('coalesce(waste.w, 0.0)')} AS mem_wastage
FROM rt LEFT JOIN waste ON waste.task_id = rt.task_id
"""))
def q_mem_wastage(spark, sf_dir):
    """memory*time over overuse reports with resources; 0.0 when none."""
    f = docs.task_figures(_scanned(spark, sf_dir)["reports"])
    return f.select("task_id", "mem_wastage")


@query("last_site", _doc_sql("""
SELECT CAST(task_id AS VARCHAR) AS task_id, site, hostname FROM lastr
"""))
def q_last_site(spark, sf_dir):
    """Site and hostname of the last report in document order (even null)."""
    f = docs.task_figures(_scanned(spark, sf_dir)["reports"]).where("n_reports > 0")
    return f.select("task_id", "site", "hostname")


@query("last_transfer_totals", _doc_sql(f"""
SELECT CAST(t.task_id AS VARCHAR) AS task_id, {r6('i.gib')} AS input_size,
       {r6('i.hrs')} AS input_duration, {r6('o.gib')} AS output_size,
       {r6('o.hrs')} AS output_duration
FROM (SELECT DISTINCT task_id FROM lastx) t
LEFT JOIN lastx i ON i.task_id = t.task_id AND i.kind = 'download'
LEFT JOIN lastx o ON o.task_id = t.task_id AND o.kind = 'upload'
"""))
def q_last_transfer_totals(spark, sf_dir):
    """Totals of the last report without error_summary having good
    transfers, per direction."""
    f = docs.task_figures(_scanned(spark, sf_dir)["reports"])
    return f.where(F.col("input_size").isNotNull() | F.col("output_size").isNotNull()).select(
        "task_id", "input_size", "input_duration", "output_size", "output_duration")


@query("report_diagnostics", with_views("""
SELECT CAST(task_id AS VARCHAR) AS task_id, stat_id, reason FROM (
  SELECT task_id, CAST(NULL AS VARCHAR) AS stat_id, 'unreadable_document' AS reason
  FROM rt WHERE task_id % 17 = 1
  UNION ALL
  SELECT ev.task_id, CAST(event_id AS VARCHAR),
         CASE WHEN overuse AND NOT has_resources THEN 'overuse_without_resources'
              WHEN overuse AND ev.task_id % 17 = 5 THEN 'overuse_bad_resources'
              WHEN has_summary OR stats_as_string THEN NULL
              WHEN ev.task_id % 17 = 2 THEN 'unreadable_task_stats'
              WHEN g.task_stat_id IS NULL THEN NULL
              WHEN ev.task_id % 17 = 4 THEN 'transfer_missing_fields'
              WHEN ev.task_id % 17 = 3 THEN 'transfer_bad_value' END
  FROM ev JOIN rt ON rt.task_id = ev.task_id
  LEFT JOIN (SELECT DISTINCT task_stat_id FROM xfer WHERE error IS NOT TRUE) g
    ON g.task_stat_id = ev.task_stat_id
  WHERE ev.task_id % 17 <> 1)
WHERE reason IS NOT NULL
""", "ev", "xfer", "rt"))
def q_report_diagnostics(spark, sf_dir):
    """Unusable reports and documents, with a reason each."""
    d = docs.report_diagnostics(flawed_reports(_scanned(spark, sf_dir)["reports"]))
    return d.select("task_id", "stat_id", "reason")


@query("job_lookup", with_views("""
SELECT CAST(task_id AS VARCHAR) AS task_id, job_index FROM rt WHERE o_orderstatus = 'F'
""", "rt"))
def q_job_lookup(spark, sf_dir):
    """Completed task -> its job within the dataset's job listing."""
    s = _scanned(spark, sf_dir)
    return s["tasks"].join(s["jobs"], ["dataset_id", "job_id"]).select("task_id", "job_index")


@query("dataset_tally", _doc_sql("""
SELECT d.dataset, coalesce(t.n_tasks, 0) AS n_tasks, coalesce(j.n_jobs, 0) AS n_jobs,
       coalesce(t.n_tasks, 0) AS n_rows
FROM (SELECT CAST(20000 + n_nationkey AS BIGINT) AS dataset, CAST(n_nationkey AS VARCHAR) AS dataset_id
      FROM nation) d
LEFT JOIN (SELECT dataset_id, count(*) AS n_tasks FROM rt WHERE o_orderstatus = 'F'
           GROUP BY dataset_id) t ON t.dataset_id = d.dataset_id
LEFT JOIN (SELECT CAST(c_nationkey AS VARCHAR) AS dataset_id, count(*) AS n_jobs
           FROM customer GROUP BY c_nationkey) j ON j.dataset_id = d.dataset_id
"""))
def q_dataset_tally(spark, sf_dir):
    """Per dataset, tasks and jobs listed and usage rows produced (the
    harvest's own tally; no report is parsed for it)."""
    from gridmeter.plans.harvest import dataset_tally
    from gridmeter.plans.usage_reports import task_rows
    s = _scanned(spark, sf_dir)
    return dataset_tally(s["datasets"], task_rows(s["datasets"], s["jobs"], s["tasks"], s["reports"]), s["jobs"])


def _land(docs_, base, kinds=("datasets", "tasks", "jobs", "reports", "configs"), at=1):
    for kind in kinds:
        docs_[kind].withColumn("landed_at", F.lit(at).cast("bigint")).write.mode("append").json(f"{base}/{kind}")


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("harvest_refresh", _doc_sql(_USAGE_SELECT + " AND rt.dataset <> 20007"))
def q_harvest_refresh(spark, sf_dir):
    """Everything lands twice, first with older content, and is harvested
    after each landing; the usage read back has the newest content once.  Dataset
    20007 has no completed task any more in the second landing: its rows go."""
    from gridmeter.plans.harvest import harvest
    new, base = landed_documents(spark, sf_dir), _fresh(spark, "refresh")
    old = dict(new)
    old["tasks"] = new["tasks"].withColumn("doc", F.regexp_replace("doc", '"requirements":\\{[^}]*\\}', '"requirements":{"memory":1}'))
    old["reports"] = new["reports"].withColumn("doc", F.lit("{}"))
    new["tasks"] = new["tasks"].withColumn("doc", F.when(F.col("dataset_id") == "7", F.replace(
        "doc", F.lit('"complete"'), F.lit('"queued"'))).otherwise(F.col("doc")))
    _land(old, f"{base}/landing")
    harvest(spark, f"{base}/landing", f"{base}/out")
    _land(new, f"{base}/landing", at=2)
    harvest(spark, f"{base}/landing", f"{base}/out", include=landed.scan_datasets(new["datasets"]))
    usage = spark.read.option("mergeSchema", "true").parquet(f"{base}/out/usage")
    return usage.withColumn("dataset", F.col("dataset").cast("bigint"))


@query("harvest_key_types", _doc_sql(_USAGE_SELECT.replace(
    "WHEN rt.req_kind = 2 THEN 'long' END AS queue_req",
    "WHEN rt.req_kind = 2 THEN CASE WHEN rt.dataset < 20012 THEN '7' ELSE 'long' END END AS queue_req")))
def q_harvest_key_types(spark, sf_dir):
    """The datasets below 20012 land with a queue that is always a number and are
    harvested; the others land with one that is text for some tasks.  The key becomes text,
    the first datasets' files are written again, and the table reads as one."""
    from gridmeter.plans.harvest import harvest
    from gridmeter.sources.sinks import read_usage
    docs_, base = landed_documents(spark, sf_dir), _fresh(spark, "key-types")
    # The two landings take their rows from one computation of the reports.
    docs_["reports"], stored = materialize(docs_["reports"], "key-types-reports", with_path=True)
    early = {k: df.where(F.col("dataset_id").cast("int") < 12) for k, df in docs_.items() if k in ("tasks", "jobs", "reports")}
    late = {k: df.where(F.col("dataset_id").cast("int") >= 12) for k, df in docs_.items() if k in ("tasks", "jobs", "reports")}
    number = F.expr("CAST(map_keys(from_json(doc, 'MAP<STRING, STRING>'))[0] AS INT)")
    early["datasets"], late["datasets"] = (docs_["datasets"].where(c) for c in (number < 12, number >= 12))
    early["tasks"] = early["tasks"].withColumn("doc", F.replace("doc", F.lit('"queue":"long"'), F.lit('"queue":7')))
    for part in (early, late):
        _land(part, f"{base}/landing", kinds=tuple(part))
        harvest(spark, f"{base}/landing", f"{base}/out")
    drop_path(spark, stored)
    return read_usage(spark, f"{base}/out")


@query("harvest_one_dataset", _doc_sql(_USAGE_SELECT))
def q_harvest_one_dataset(spark, sf_dir):
    """Listings land in a folder per dataset and are harvested; three datasets are
    then harvested again, by the file index from their own files alone."""
    from gridmeter.plans.harvest import harvest
    from gridmeter.sources.sinks import read_usage
    docs_, base = landed_documents(spark, sf_dir), _fresh(spark, "one")
    for kind in ("tasks", "jobs", "reports"):
        docs_[kind].hint("rebalance", "dataset_id").write.partitionBy("dataset_id").json(f"{base}/landing/{kind}")
    docs_["datasets"].write.json(f"{base}/landing/datasets")
    harvest(spark, f"{base}/landing", f"{base}/out")
    harvest(spark, f"{base}/landing", f"{base}/out", include=[20003, 20004, 20011])
    return read_usage(spark, f"{base}/out")


@query("harvest_resume", _doc_sql("""
SELECT d.dataset, coalesce(t.n, 0) AS n_tasks, coalesce(j.n, 0) AS n_jobs, coalesce(t.n, 0) AS n_rows
FROM (SELECT CAST(20000 + n_nationkey AS BIGINT) AS dataset, CAST(n_nationkey AS VARCHAR) AS dataset_id
      FROM nation WHERE n_nationkey >= 3) d
LEFT JOIN (SELECT dataset_id, count(*) AS n FROM rt WHERE o_orderstatus = 'F' GROUP BY 1) t USING (dataset_id)
LEFT JOIN (SELECT CAST(c_nationkey AS VARCHAR) AS dataset_id, count(*) AS n FROM customer GROUP BY 1) j USING (dataset_id)
"""))
def q_harvest_resume(spark, sf_dir):
    """Three datasets are harvested by number; the next harvest does
    exactly the others, by the ledger.  Returns its ledger rows."""
    from gridmeter.plans.harvest import harvest
    base = _fresh(spark, "resume")
    _land(landed_documents(spark, sf_dir), f"{base}/landing")
    harvest(spark, f"{base}/landing", f"{base}/out", include=[20000, 20001, 20002])
    return harvest(spark, f"{base}/landing", f"{base}/out")


@query("config_export", """
SELECT CAST(n_nationkey AS VARCHAR) AS dataset_id,
       CASE WHEN n_nationkey % 10 <> 9 THEN n_name END AS description, n_nationkey % 10 = 9 AS skipped
FROM nation
""")
def q_config_export(spark, sf_dir):
    """Config documents written one per line and read back; datasets without one."""
    from gridmeter.plans.harvest import export_configs
    base = _fresh(spark, "configs")
    _land(landed_documents(spark, sf_dir), f"{base}/landing", kinds=("configs",))
    skipped = export_configs(spark, f"{base}/landing", f"{base}/out")
    lines = spark.read.schema("dataset_id STRING, description STRING").json(f"{base}/out")
    return lines.withColumn("skipped", F.lit(False)).unionByName(
        skipped.select("dataset_id", F.lit(None).cast("string").alias("description"), F.lit(True).alias("skipped")))


@query("missing_jobs", with_views("""
SELECT dataset_id, CAST(task_id AS VARCHAR) AS task_id, CAST(job_id AS VARCHAR) AS job_id, 'missing_job' AS reason
FROM rt WHERE o_orderstatus = 'F' AND job_id % 5 = 0
""", "rt"))
def q_missing_jobs(spark, sf_dir):
    """Completed tasks whose job is not listed (every fifth job is left out of the listing)."""
    from gridmeter.plans.usage_reports import missing_jobs
    s = _scanned(spark, sf_dir)
    return missing_jobs(s["tasks"], s["jobs"].where(F.col("job_id").cast("bigint") % 5 != 0))
