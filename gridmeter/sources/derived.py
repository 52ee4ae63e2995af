"""Inputs of this domain derived from the driver's generic tables.

The driver ships TPC-H-like tables; the batch-system tables are defined over
them as pure expressions, so every query's work grows with the driver data:

  dataset   <- nation     job <- customer     task_rel <- part
  task, search <- orders   task_stat (JSON reports) <- events
  transfers inside each report <- lineitem rows of the report's task

The same definitions, written relationally, live in `gridmeter.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.constants import OVERUSE_PREFIX
from gridmeter.sources.tables import Tables

# Fixed values of the derivation.
N_TASK_RELS = 200             # task.task_rel_id = o_orderkey % 200
N_REL_DATASETS = 25           # task_rel.dataset_id = p_partkey % 25
N_TASK_INDEX = 7              # task_rel.task_index = p_partkey % 7
REPORTS_PER_TASK = 3          # task_stat.task_id = event_id div 3
NO_RESOURCES_EVERY = 13       # overuse reports without resources: event_id % 13 = 0
STRING_STATS_EVERY = 11       # task_stats stored as a JSON string: event_id % 11 = 0
NO_SITE_EVERY = 7             # site absent when user_id % 7 = 0
N_SITES = 5
DATASET_BASE = 20000          # document path: dataset number = 20000 + n_nationkey
STATUS = {"F": "complete", "O": "queued", "P": "processing"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(c: Column) -> Column:
    return c.cast("string").cast("binary")


def _status(c: Column) -> Column:
    out = F.lit(None).cast("string")
    expr = None
    for k, v in STATUS.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(out)


def _rel_requirements(partkey: Column, size: Column) -> Column:
    kind = partkey % 5
    return (F.when(kind == 0, F.lit('{"memory":"$eval(x)"}'))
             .when(kind == 1, F.lit("{}"))
             .otherwise(F.concat(F.lit('{"memory":'), size.cast("string"), F.lit("}"))))


def _task_requirements(orderkey: Column) -> Column:
    kind = orderkey % 4
    return (F.when(kind == 0, F.concat(F.lit('{"memory":'), (orderkey % 16).cast("string"),
                                       F.lit("}")))
             .when(kind == 1, F.lit('{"memory":null}'))
             .otherwise(F.lit("")))


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transfer record: (event_id, kind, record struct)."""
    ev = load(spark, sf_dir, "events").where(F.col("event_type") != "error") \
        .select("event_id")
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice",
        "l_quantity")
    joined = li.join(
        ev,
        (F.col("l_orderkey") == F.expr(f"event_id div {REPORTS_PER_TASK}"))
        & ((F.col("l_linenumber") % 3) == (F.col("event_id") % 3)),
    )
    return joined.select(
        "event_id",
        F.when(F.col("l_returnflag") == "A", "download").otherwise("upload").alias("kind"),
        F.struct(
            (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 1000).alias("size"),
            F.col("l_quantity").alias("duration"),
            F.when(F.col("l_linenumber") == 7, F.lit(None).cast("boolean"))
             .otherwise(F.col("l_linestatus") == "F").alias("error"),
        ).alias("record"),
    )


def report_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, task_id, stat JSON text) in the report shape."""
    ev = load(spark, sf_dir, "events")
    # A report's transfer list is one document's content: bounded by the
    # lineitems of one order that share the report's line-number residue.
    xf = transfers(spark, sf_dir).groupBy("event_id").agg(
        F.collect_list(F.when(F.col("kind") == "download", F.col("record"))).alias("download"),
        F.collect_list(F.when(F.col("kind") == "upload", F.col("record"))).alias("upload"),
    )
    e = ev.join(xf, "event_id", "left")
    etype = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    no_resources = (etype == "error") & (F.col("event_id") % NO_RESOURCES_EVERY == 0)
    as_string = F.col("event_id") % STRING_STATS_EVERY == 0

    def nonempty(a):
        return F.when(F.size(a) > 0, a)

    task_stats = F.struct(nonempty(F.col("download")).alias("download"),
                          nonempty(F.col("upload")).alias("upload"))
    error = (F.when(etype.isin("error", "signup"), F.lit(True))
              .when(etype == "purchase", F.lit(False)))
    summary = (F.when(etype == "error", F.concat(F.lit(OVERUSE_PREFIX + ": "),
                                                 F.col("value").cast("string"), F.lit(" GB")))
                .when(etype == "signup", F.lit("Other failure")))
    resources = F.when(~no_resources, F.struct(
        F.col("value").alias("memory"),
        (k.cast("double") / 10.0).alias("time"),
        F.when(etype == "purchase", F.lit(1)).alias("cpu"),
        # A text key, and a key that is a number for some and text for others.
        F.when(etype == "purchase", F.concat(F.lit("n"), (F.col("user_id") % 4).cast("string"))).alias("node"),
    ))
    site = F.when(F.col("user_id") % NO_SITE_EVERY != 0,
                  F.concat(F.lit("site"), (F.col("user_id") % N_SITES).cast("string")))
    base = F.to_json(F.struct(
        error.alias("error"),
        summary.alias("error_summary"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        site.alias("site"),
        F.concat(F.lit("host"), F.col("user_id").cast("string")).alias("hostname"),
        resources.alias("resources"),
        F.when((etype != "error") & ~as_string, task_stats).alias("task_stats"),
    ))
    # Early reports hold task_stats as a string containing JSON.
    wrapped = F.when((etype != "error") & as_string, F.to_json(F.struct(F.to_json(task_stats).alias("task_stats"))))
    spliced = F.concat(F.expr("substring(base, 1, length(base) - 1)"), F.lit(","),
                       F.expr("substring(wrapped, 2)"))
    return (e.withColumn("base", base).withColumn("wrapped", wrapped)
             .select("event_id",
                     F.expr(f"event_id div {REPORTS_PER_TASK}").alias("task_id"),
                     F.when((etype != "error") & as_string, spliced)
                      .otherwise(F.col("base")).alias("stat")))


def table_views(spark: SparkSession, sf_dir: str) -> Tables:
    """The six tables, in their stored shape (byte-string text columns)."""
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer")
    part = load(spark, sf_dir, "part")
    orders = load(spark, sf_dir, "orders")
    dataset = nation.select(_bytes(F.col("n_nationkey")).alias("dataset_id"),
                            _bytes(F.col("n_name")).alias("name"))
    job = customer.select(F.col("c_custkey").alias("job_id"),
                          _bytes(F.col("c_nationkey")).alias("dataset_id"),
                          _bytes(F.col("c_mktsegment")).alias("status"),
                          F.col("c_custkey").cast("int").alias("job_index"))
    task_rel = part.select(
        F.col("p_partkey").alias("task_rel_id"),
        _bytes(F.col("p_partkey") % N_REL_DATASETS).alias("dataset_id"),
        (F.col("p_partkey") % N_TASK_INDEX).cast("int").alias("task_index"),
        _bytes(F.col("p_type")).alias("name"),
        _rel_requirements(F.col("p_partkey"), F.col("p_size")).alias("requirements"))
    task = orders.select(
        F.col("o_orderkey").alias("task_id"),
        _bytes(_status(F.col("o_orderstatus"))).alias("status"),
        _task_requirements(F.col("o_orderkey")).alias("requirements"),
        (F.col("o_orderkey") % N_TASK_RELS).alias("task_rel_id"))
    search = orders.select(
        F.col("o_orderkey").alias("task_id"),
        F.col("o_custkey").alias("job_id"),
        _bytes((F.col("o_orderkey") % N_TASK_RELS) % N_REL_DATASETS).alias("dataset_id"),
        _bytes(F.col("o_orderpriority")).alias("name"),
        _bytes(_status(F.col("o_orderstatus"))).alias("task_status"))
    task_stat = report_stats(spark, sf_dir).select(
        F.col("event_id").alias("task_stat_id"), "task_id", "stat")
    return Tables(task=task, task_rel=task_rel, search=search, job=job,
                  task_stat=task_stat, dataset=dataset)


def broken_tables(tables: Tables) -> dict[str, DataFrame]:
    """The tables with breaches of their contracts: repeated report ids, references to
    nothing, missing references and values, a dataset that is gone."""
    tid = F.col("task_id")
    return {
        "dataset": tables.dataset.where(F.col("dataset_id").cast("string") != "3"),
        "job": tables.job,
        "task_rel": tables.task_rel,
        "task": tables.task.withColumn("requirements", F.when(tid % 14 != 0, F.col("requirements"))),
        "search": tables.search.withColumns({
            "job_id": F.when(tid % 15 == 0, F.lit(None)).when(tid % 12 == 0, F.col("job_id") + 10_000_000)
                       .otherwise(F.col("job_id")),
            "task_status": F.when(tid % 9 != 0, F.col("task_status"))}),
        "task_stat": tables.task_stat.unionAll(tables.task_stat.where(F.col("task_stat_id") % 10 == 0)),
    }


# ---------------------------------------------------------------- document path


def _rest_requirements(orderkey: Column) -> Column:
    """Requirement objects of the task listing: keys differ from task to task."""
    kind = orderkey % 4
    return (F.when(kind == 0, F.concat(F.lit('{"cpu":1,"memory":'),
                                       (orderkey % 16).cast("string"), F.lit(',"queue":'),
                                       (orderkey % 3).cast("string"),
                                       F.lit(',"os":"RHEL_7_x86_64"}')))
             .when(kind == 1, F.lit('{"memory":null,"arch":"x86"}'))
             .when(kind == 2, F.lit('{"memory":2.5,"gpu":1,"queue":"long"}'))
             .otherwise(F.lit("{}")))


def _quoted(c: Column) -> Column:
    """A digit string as a JSON string literal (digits need no escaping)."""
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def _keyed(key: Column, value_json: Column) -> Column:
    """`{"<key>": <value>}` as JSON text."""
    return F.concat(F.lit("{"), _quoted(key), F.lit(":"), value_json, F.lit("}"))


# Flaws of `flawed_reports`, by task_id % FLAW_EVERY.
FLAW_EVERY = 17


def flawed_reports(reports: DataFrame) -> DataFrame:
    """Report documents of which some cannot be read: truncated documents (1),
    task_stats that is no JSON (2), sizes that are no numbers (3), transfers
    without a duration (4), resources whose memory is no number (5)."""
    flaw = F.col("task_id").cast("bigint") % FLAW_EVERY
    doc = F.col("doc")
    return reports.withColumn("doc", (
        F.when(flaw == 1, F.expr("substring(doc, 1, length(doc) - 1)"))
         .when(flaw == 2, F.replace(doc, F.lit('"task_stats":{'), F.lit('"task_stats":"not json","was":{')))
         .when(flaw == 3, F.replace(doc, F.lit('"size":'), F.lit('"size":"big","was":')))
         .when(flaw == 4, F.replace(doc, F.lit('"duration":'), F.lit('"seconds":')))
         .when(flaw == 5, F.replace(doc, F.lit('"memory":'), F.lit('"memory":"much","was":')))
         .otherwise(doc)))


def flawed_stats(task_stat: DataFrame) -> DataFrame:
    """The same flaws in the table path's reports, by report id, and an error that is
    no boolean (6), a time that is none (7), a transfer error that is no boolean (8)."""
    flaw = F.col("task_stat_id") % FLAW_EVERY
    s = F.col("stat")
    return task_stat.withColumn("stat", (
        F.when(flaw == 1, F.expr("substring(stat, 1, length(stat) - 1)"))
         .when(flaw == 3, F.replace(s, F.lit('"size":'), F.lit('"size":"big","was":')))
         .when(flaw == 4, F.replace(s, F.lit('"duration":'), F.lit('"duration":"x","was":')))
         .when(flaw == 5, F.replace(s, F.lit('"memory":'), F.lit('"memory":"$eval(x)","was":')))
         .when(flaw == 6, F.concat(F.lit('{"error":"maybe",'), F.expr("substring(regexp_replace(stat, '\"error\":(true|false),', ''), 2)")))
         .when(flaw == 7, F.replace(s, F.lit('"time":"'), F.lit('"time":"about ')))
         .when(flaw == 8, F.regexp_replace(s, '("duration":[0-9.]+,"error":)(true|false)', '$1"perhaps"'))
         .otherwise(s)))


def landed_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landed listing documents, one JSON record per row, as the scans read them.

    Listings are objects keyed by id; each landed record holds one key (one
    entity), except reports: one record per task holding that task's whole
    report object, keys in report order.
    """
    nation = load(spark, sf_dir, "nation")
    customer = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders")
    datasets = nation.select(_keyed(
        F.col("n_nationkey"),
        F.to_json(F.struct((F.col("n_nationkey") + DATASET_BASE).alias("dataset"),
                           F.col("n_nationkey").cast("string").alias("dataset_id")))
    ).alias("doc"))
    jobs = customer.select(
        F.col("c_nationkey").cast("string").alias("dataset_id"),
        _keyed(F.col("c_custkey"),
               F.to_json(F.struct(F.col("c_custkey").cast("int").alias("job_index")))).alias("doc"))
    ot = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                     "o_custkey")
    task_body = F.concat(
        F.lit('{"dataset_id":'), _quoted(F.col("c_nationkey")),
        F.lit(',"job_id":"'), F.col("o_custkey").cast("string"),
        F.lit('","task_id":"'), F.col("o_orderkey").cast("string"),
        F.lit('","task_index":'), (F.col("o_orderkey") % N_TASK_INDEX).cast("string"),
        F.lit(',"requirements":'), _rest_requirements(F.col("o_orderkey")),
        F.lit(',"status":"'), _status(F.col("o_orderstatus")), F.lit('"}'))
    tasks = ot.select(F.col("c_nationkey").cast("string").alias("dataset_id"),
                      _keyed(F.col("o_orderkey"), task_body).alias("doc"))
    stats = report_stats(spark, sf_dir)
    # One document per task: its reports in event order (at most three per task
    # by construction of the derivation).
    per_task = stats.groupBy("task_id").agg(F.array_sort(F.collect_list(
        F.struct("event_id", F.concat(_quoted(F.col("event_id")), F.lit(':{"stats":'),
                                      F.col("stat"), F.lit("}")).alias("entry")))).alias("entries"))
    reports = ot.join(per_task, F.col("o_orderkey") == F.col("task_id"), "left").select(
        F.col("c_nationkey").cast("string").alias("dataset_id"),
        F.col("o_orderkey").cast("string").alias("task_id"),
        F.concat(F.lit("{"), F.coalesce(F.array_join(F.col("entries.entry"), ","), F.lit("")),
                 F.lit("}")).alias("doc"))
    configs = nation.select(
        F.col("n_nationkey").cast("string").alias("dataset_id"),
        F.when(F.col("n_nationkey") % 10 != 9, F.to_json(F.struct(
            F.col("n_nationkey").cast("string").alias("dataset_id"),
            F.col("n_name").alias("description"),
            F.array(F.struct(F.lit("main").alias("name"))).alias("tasks")))).alias("doc"))
    return {"datasets": datasets, "jobs": jobs, "tasks": tasks, "reports": reports,
            "configs": configs}
