"""Queries of the table copy and of the table contracts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridmeter.catalog import query
from gridmeter.catalog.tables_q import _DERIVED, _NUMERIC_NAMED, _numeric_named, _views
from gridmeter.oracle import r6, with_views
from gridmeter.operators import copy, quality
from gridmeter.schemas import PRIMARY_KEYS, REFERENCES, TABLES
from gridmeter.session import scratch_path
from gridmeter.sources.derived import broken_tables, load, table_views

_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
_LI_OUT = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity, "
           "round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount, "
           "round(l_tax, 6) AS l_tax, l_returnflag, l_linestatus, l_shipdate")


@query("insert_ignore", f"""
WITH t AS (SELECT {_LI_COLS} FROM (
             SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                          ORDER BY {_LI_COLS}) AS rn
             FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1),
     b AS (SELECT {_LI_COLS} FROM (
             SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                          ORDER BY {_LI_COLS}) AS rn
             FROM lineitem) WHERE rn = 1),
     u AS (SELECT * FROM t
           UNION ALL
           SELECT * FROM b WHERE NOT EXISTS (
             SELECT 1 FROM t WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber))
SELECT {_LI_OUT} FROM u
""")
def q_insert_ignore(spark, sf_dir):
    """Insert ignoring existing keys (in the target or earlier in the batch):
    first the 'R' rows, then all rows, keyed on (l_orderkey, l_linenumber)."""
    li = load(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    target = copy.insert_ignore(None, li.where(F.col("l_returnflag") == "R"), key)
    return copy.insert_ignore(target, li, key)


@query("copy_filtered", f"""
WITH {_NUMERIC_NAMED}
SELECT n.p_partkey, n.name, p.p_size FROM named n JOIN part p ON p.p_partkey = n.p_partkey
WHERE (try_cast(n.name AS DOUBLE) IS NULL OR try_cast(n.name AS DOUBLE) <> 4)
  AND (try_cast(n.name AS DOUBLE) IS NULL OR try_cast(n.name AS DOUBLE) > 1)
""")
def q_copy_filtered(spark, sf_dir):
    """Rows passing the name rules (`name != 4 AND name > 1`, numeric
    names compared as numbers, text names pass) are copied into a stored table in two
    overlapping copies; each appends only rows whose key is not there."""
    from gridmeter.functions.text import name_above, name_not_equal
    src = _numeric_named(spark, sf_dir).join(
        load(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    path = scratch_path(spark, f"copy-{uuid.uuid4().hex[:12]}")
    kept = name_not_equal("name", 4) & name_above("name", 1)
    copy.copy_table(src.where("p_partkey % 3 = 0"), path, ["p_partkey"], kept)
    return copy.copy_table(src, path, ["p_partkey"], kept)


@query("copy_semi_join", with_views(f"""
SELECT ev.task_stat_id, ev.task_id FROM ev
WHERE ev.has_resources AND ev.task_id IN (
  SELECT tk.task_id FROM tk JOIN (
    SELECT p_partkey AS task_rel_id, p_partkey % 25 AS dataset_id,
           CASE WHEN p_partkey % 10 = 0 THEN CAST(p_partkey % 6 AS VARCHAR) ELSE p_type END AS name
    FROM part) r ON r.task_rel_id = tk.task_rel_id
  WHERE (try_cast(r.name AS DOUBLE) IS NULL OR try_cast(r.name AS DOUBLE) > 4)
    AND r.dataset_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 8 <> 4))
""", "ev", "tk"))
def q_copy_semi_join(spark, sf_dir):
    """Reports worth copying whose task belongs to a kept task type of
    a kept dataset (two-level semi-join with an inner join inside)."""
    v = _views(spark, sf_dir)
    stats = copy.resource_reports(v.task_stat).join(_kept_tasks(spark, sf_dir, v), "task_id", "left_semi")
    return stats.select("task_stat_id", "task_id")


def _kept_tasks(spark, sf_dir, v):
    """Tasks of kept task types (name > 4) of kept datasets (name != 20000; every eighth has that name)."""
    from gridmeter.functions.text import name_above, name_not_equal
    named = _numeric_named(spark, sf_dir).withColumnRenamed("p_partkey", "task_rel_id")
    rel = v.task_rel.drop("name").join(named, "task_rel_id")
    names = F.when(F.col("dataset_id").cast("int") % 8 == 4, F.lit("20000")).otherwise(F.col("name"))
    datasets = v.dataset.withColumn("name", names).where(name_not_equal("name", 20000)).select("dataset_id")
    rel = rel.where(name_above("name", 4)).join(datasets, "dataset_id", "left_semi")
    return v.task.join(rel.select("task_rel_id"), "task_rel_id", "left_semi").select("task_id")


@query("copy_tasks_with_reports", with_views("""
SELECT tk.task_id, tk.task_rel_id FROM tk JOIN (
    SELECT p_partkey AS task_rel_id, p_partkey % 25 AS dataset_id,
           CASE WHEN p_partkey % 10 = 0 THEN CAST(p_partkey % 6 AS VARCHAR) ELSE p_type END AS name
    FROM part) r ON r.task_rel_id = tk.task_rel_id
WHERE (try_cast(r.name AS DOUBLE) IS NULL OR try_cast(r.name AS DOUBLE) > 4)
  AND r.dataset_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 8 <> 4)
  AND tk.task_id IN (SELECT task_id FROM ev WHERE has_resources)
""", "ev", "tk"))
def q_copy_tasks_with_reports(spark, sf_dir):
    """Kept tasks that have a report worth copying, written to a stored table."""
    v = _views(spark, sf_dir)
    tasks = v.task.join(_kept_tasks(spark, sf_dir, v), "task_id", "left_semi")
    tasks = tasks.join(copy.resource_reports(v.task_stat).select("task_id"), "task_id", "left_semi")
    path = scratch_path(spark, f"copy-{uuid.uuid4().hex[:12]}")
    return copy.copy_table(tasks, path, ["task_id"]).select("task_id", "task_rel_id")


@query("copy_indexed", f"""
SELECT {_LI_OUT} FROM (
  SELECT {_LI_COLS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY part, {_LI_COLS}) AS rn
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 2 ELSE 3 END AS part FROM lineitem))
WHERE rn = 1
""")
def q_copy_indexed(spark, sf_dir):
    """Three successive inserts into a stored table by its key index; of a key that
    several bring, the first one's row stays."""
    from gridmeter.operators.key_index import KeyIndex
    li = load(spark, sf_dir, "lineitem").select(*[c.strip() for c in _LI_COLS.split(",")])
    path = scratch_path(spark, f"indexed-{uuid.uuid4().hex[:12]}")
    index = KeyIndex(spark, f"{path}/table", f"{path}/index", ["l_orderkey", "l_linenumber"], li.schema, 16)
    for batch in ("l_returnflag = 'R'", "l_returnflag = 'A'", "true"):
        stored = index.insert(li.where(batch))
    return stored


@query("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_check_unique(spark, sf_dir):
    """Primary-key uniqueness (repeated keys with their count)."""
    return quality.check_unique(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _broken(spark, sf_dir):
    return broken_tables(table_views(spark, sf_dir))


@query("check_keys", """
SELECT t AS table_name, coalesce(n, 0) AS n_keys, coalesce(2 * n, 0) AS n_rows
FROM (VALUES ('dataset'), ('job'), ('task_rel'), ('task'), ('search'), ('task_stat')) v(t)
LEFT JOIN (SELECT 'task_stat' AS t, count(*) AS n FROM events WHERE event_id % 10 = 0) USING (t)
""")
def q_check_keys(spark, sf_dir):
    """Repeated primary keys of the six tables (every tenth report is there twice)."""
    return quality.check_keys(_broken(spark, sf_dir), PRIMARY_KEYS)


@query("check_references", with_views("""
SELECT 'search' AS child, 'task_id' AS column_name, 'task' AS parent,
       count(*) FILTER (WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_orphans
FROM orders
UNION ALL SELECT 'search', 'job_id', 'job',
       count(*) FILTER (WHERE o_orderkey % 15 <> 0 AND (o_orderkey % 12 = 0
                        OR o_custkey NOT IN (SELECT c_custkey FROM customer))) FROM orders
UNION ALL SELECT 'search', 'dataset_id', 'dataset',
       count(*) FILTER (WHERE (o_orderkey % 200) % 25 NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey <> 3))
FROM orders
UNION ALL SELECT 'task_rel', 'dataset_id', 'dataset',
       count(*) FILTER (WHERE p_partkey % 25 NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey <> 3)) FROM part
UNION ALL SELECT 'task', 'task_rel_id', 'task_rel',
       count(*) FILTER (WHERE o_orderkey % 200 NOT IN (SELECT p_partkey FROM part)) FROM orders
UNION ALL SELECT 'task_stat', 'task_id', 'task',
       (count(*) FILTER (WHERE event_id // 3 NOT IN (SELECT o_orderkey FROM orders)))
       + (count(*) FILTER (WHERE event_id % 10 = 0 AND event_id // 3 NOT IN (SELECT o_orderkey FROM orders))) FROM events
""", "ev"))
def q_check_references(spark, sf_dir):
    """Referential integrity (orphan count per reference; a NULL reference is none)."""
    return quality.check_references(_broken(spark, sf_dir), REFERENCES)


# NULLs that the broken tables hold; every other required column has none.
_NULLS = {("task", "requirements"): "o_orderkey % 14 = 0", ("search", "job_id"): "o_orderkey % 15 = 0",
          ("search", "task_status"): "o_orderkey % 9 = 0"}


@query("check_not_null", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"count(*) FILTER (WHERE {_NULLS.get((t, c), 'false')}) AS n_null FROM {src}"
    for t, (src, columns) in _DERIVED.items() for c in columns))
def q_check_not_null(spark, sf_dir):
    """D3: NULL count of every required column of the six tables (one scan each)."""
    return quality.check_required(_broken(spark, sf_dir), TABLES)


@query("fill_defaults", f"""
SELECT o.o_orderkey, coalesce(l.l_linenumber, 0) AS l_linenumber,
       {r6('coalesce(l.l_quantity, 0)')} AS l_quantity
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_fill_defaults(spark, sf_dir):
    """Column defaults (0) applied where values are missing."""
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                                "l_linenumber", "l_quantity")
    return quality.fill_defaults(o.join(li, "o_orderkey", "left"), ["l_linenumber", "l_quantity"])


# Every column with a declared default: its source table, and its value where it is there.
_DEFAULTS = {
    "dataset": ("customer", {"priority": "c_custkey % 10", "jobs_submitted": "c_custkey % 7", "tasks_submitted": "c_custkey % 11",
                             "debug": "c_custkey % 2"}),
    "job": ("customer", {"job_index": "c_custkey % 101"}),
    "task_rel": ("part", {"task_index": "p_partkey % 7"}),
    "task": ("orders", {"failures": "o_orderkey % 3", "evictions": "o_orderkey % 5", "walltime": "o_orderkey / 4.0",
                        "walltime_err": "o_orderkey / 8.0", "walltime_err_n": "o_orderkey % 13"}),
}
_KEY_OF = {"customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey"}


@query("declared_defaults", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {_KEY_OF[src]} % {5 + i} = 0 OR {e} = 0) AS n_zero, "
    f"round(sum(CASE WHEN {_KEY_OF[src]} % {5 + i} = 0 THEN 0 ELSE CAST({e} AS DOUBLE) END), 6) AS total FROM {src}"
    for t, (src, columns) in _DEFAULTS.items() for i, (c, e) in enumerate(columns.items())))
def q_declared_defaults(spark, sf_dir):
    """The eleven columns declared with a default, each missing in some rows, as the
    scan of the tables gives them."""
    from gridmeter.sources.tables import Tables, normalize
    made = {}
    for name, (src, columns) in _DEFAULTS.items():
        df = load(spark, sf_dir, src)
        made[name] = df.select(*[
            F.expr(f"CASE WHEN {_KEY_OF[src]} % {5 + i} <> 0 THEN {e} END").cast(TABLES[name][c].dataType).alias(c)
            for i, (c, e) in enumerate(columns.items())])
    tables = normalize(Tables(**{n: made.get(n) for n in ("task", "task_rel", "search", "job", "task_stat", "dataset")}))
    out = None
    for name, df in tables.items():
        sums = df.agg(F.count(F.lit(1)).alias("n_rows"), *[e for c in df.columns for e in (
            F.count(F.when(F.col(c) == 0, 1)).alias(f"{c}_zero"), F.sum(F.col(c).cast("double")).alias(f"{c}_total"))])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_zero").alias("n_zero"), F.col(f"{c}_total").alias("total"))
                         for c in df.columns])
        part = sums.select(F.lit(name).alias("table_name"), "n_rows", F.explode(rows).alias("r")).select("table_name", "n_rows", "r.*")
        out = part if out is None else out.unionByName(part)
    return out


@query("union_rows", """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment,
       s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal
FROM (SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier)
""")
def q_union_rows(spark, sf_dir):
    """Stack rows with differing columns; missing columns are NULL."""
    return load(spark, sf_dir, "customer").unionByName(load(spark, sf_dir, "supplier"),
                                                       allowMissingColumns=True)
