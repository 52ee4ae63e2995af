"""DuckDB oracle building blocks: the derived views written relationally.

The oracles never parse the JSON the engine reads; they compute the same
figures straight from the generating columns of the driver tables, so the
JSON encode -> parse -> aggregate chain of the engine is checked
independently.  Every oracle is one SQL statement: `with_views` prefixes the
CTEs it needs.
"""

from __future__ import annotations

# Reports: the fields each event's report carries.
EV = """ev AS (
  SELECT event_id AS task_stat_id, event_id // 3 AS task_id, event_id, ts, user_id, event_type,
         value,
         CASE WHEN event_type IN ('error', 'signup') THEN TRUE
              WHEN event_type = 'purchase' THEN FALSE END AS error,
         event_type IN ('error', 'signup') AS has_summary,
         event_type = 'error' AS overuse,
         NOT (event_type = 'error' AND event_id % 13 = 0) AS has_resources,
         CASE WHEN NOT (event_type = 'error' AND event_id % 13 = 0) THEN value END AS memory,
         CASE WHEN NOT (event_type = 'error' AND event_id % 13 = 0)
              THEN CAST(json_extract_string(props, '$.k') AS INTEGER) / 10 END AS hours,
         CASE WHEN NOT (event_type = 'error' AND event_id % 13 = 0) AND event_type = 'purchase'
              THEN CAST(1.0 AS DOUBLE) END AS cpu,
         CASE WHEN NOT (event_type = 'error' AND event_id % 13 = 0) AND event_type = 'purchase'
              THEN 'n' || CAST(user_id % 4 AS VARCHAR) END AS node,
         CASE WHEN user_id % 7 <> 0 THEN 'site' || CAST(user_id % 5 AS VARCHAR) END AS site,
         'host' || CAST(user_id AS VARCHAR) AS hostname,
         event_type <> 'error' AS has_task_stats,
         event_id % 11 = 0 AS stats_as_string
  FROM events)"""

# Transfers: lineitem rows of the report's task, matched on line number % 3.
XFER = """xfer AS (
  SELECT e.event_id AS task_stat_id, e.event_id // 3 AS task_id,
         CASE WHEN l.l_returnflag = 'A' THEN 'download' ELSE 'upload' END AS kind,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) * 1000 AS size,
         l.l_quantity AS duration,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_linestatus = 'F' END AS error,
         e.event_id % 11 = 0 AS stats_as_string
  FROM lineitem l JOIN events e
    ON l.l_orderkey = e.event_id // 3 AND l.l_linenumber % 3 = e.event_id % 3
  WHERE e.event_type <> 'error')"""

# Tasks: req_kind 0 -> {"memory": key % 16}, 1 -> {"memory": null}, else ''.
TK = """tk AS (
  SELECT o_orderkey AS task_id, o_orderkey % 200 AS task_rel_id, o_custkey AS job_id,
         o_orderstatus, o_orderkey % 4 AS req_kind
  FROM orders)"""

# Task types: req_kind 0 -> '$eval(x)' memory, 1 -> {}, else {"memory": p_size}.
REL = """rel AS (
  SELECT p_partkey AS task_rel_id, CAST(p_partkey % 25 AS VARCHAR) AS dataset_id,
         CAST(p_partkey % 7 AS INTEGER) AS task_index, p_type AS task_name, p_size,
         p_partkey % 5 AS req_kind
  FROM part)"""

JB = """jb AS (
  SELECT c_custkey AS job_id, CAST(c_nationkey AS VARCHAR) AS dataset_id,
         CAST(c_custkey AS INTEGER) AS job_index
  FROM customer)"""

# Document path: tasks of the task listing (dataset from the job's customer).
RT = """rt AS (
  SELECT o.o_orderkey AS task_id, CAST(c.c_nationkey AS VARCHAR) AS dataset_id,
         o.o_custkey AS job_id, CAST(o.o_orderkey % 7 AS INTEGER) AS task_index,
         CAST(c.c_custkey AS INTEGER) AS job_index,
         CAST(20000 + c.c_nationkey AS BIGINT) AS dataset,
         o.o_orderstatus, o.o_orderkey % 4 AS req_kind
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)"""

# Reports in document order per task (ord = 0, 1, 2 ... by event id).
EVO = """evo AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY task_id ORDER BY event_id) - 1 AS INTEGER) AS ord
  FROM ev)"""

VIEWS = {"ev": EV, "xfer": XFER, "tk": TK, "rel": REL, "jb": JB, "rt": RT, "evo": EVO}
DEPENDS = {"evo": ["ev"]}


def with_views(sql: str, *names: str, extra: str = "") -> str:
    """Prefix `sql` (a SELECT) with the CTEs it uses, then any `extra` CTEs."""
    ordered: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)
    for n in names:
        add(n)
    ctes = [VIEWS[n] for n in ordered] + ([extra.strip()] if extra.strip() else [])
    return "WITH " + ",\n".join(ctes) + "\n" + sql.strip()


def id2num(x: str) -> str:
    """id2num in DuckDB: exact HUGEINT value of the digits, minus 1, mod 10^15."""
    digit = ("(CASE WHEN ascii(c) >= 97 THEN ascii(c) - 96 WHEN ascii(c) >= 65 "
             "THEN ascii(c) - 38 ELSE ascii(c) + 5 END)::HUGEINT")
    return (f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) = '' THEN CAST(-1 AS BIGINT) "
            f"ELSE CAST((list_reduce(list_transform(string_split({x}, ''), lambda c: {digit}), "
            f"lambda a, d: a * 62 + d, 0::HUGEINT) - 1) % 1000000000000000 AS BIGINT) END)")


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"
