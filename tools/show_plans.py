"""Print the formatted physical plans of the headline queries (for PLANS.md).

Usage: python tools/show_plans.py [sf_dir]
The derived tables are written once to a scratch folder as Parquet so the
plans show real file scans (pushed filters, read schemas).
"""

from __future__ import annotations

import io
import os
import sys
import uuid
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()      # the tree, without node details


def main():
    from gridmeter.plans.usage_reports import usage_from_reports
    from gridmeter.plans.usage_tables import usage_from_tables
    from gridmeter.session import get_session, scratch_path
    from gridmeter.sources import landed
    from gridmeter.sources.derived import landed_documents, table_views
    from gridmeter.sources.tables import Tables

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    base = scratch_path(spark, f"plans-{uuid.uuid4().hex[:8]}")
    for name, df in table_views(spark, sf_dir).items():
        df.write.parquet(f"{base}/tables/{name}")
    for kind, df in landed_documents(spark, sf_dir).items():
        df.write.json(f"{base}/landing/{kind}")
    t = Tables(**{n: spark.read.parquet(f"{base}/tables/{n}") for n in
                  ("task", "task_rel", "search", "job", "task_stat", "dataset")})
    raw = {k: landed.read_landed(spark, f"{base}/landing", k)
           for k in ("datasets", "tasks", "jobs", "reports")}
    import bench
    from pyspark.sql import functions as F
    byte_ids = Tables(**{n: df.select(*[bench._as_bytes(c) if c in bench.ID_COLUMNS else F.col(c) for c in df.columns])
                         for n, df in t.items()})
    from gridmeter.operators.copy import new_rows
    plans = {
        "usage_from_tables": lambda: usage_from_tables(t),
        "usage_from_tables, byte ids, broadcasts off": lambda: usage_from_tables(byte_ids),
        "new_rows, broadcasts off": lambda: new_rows(t.search, t.search, ["task_id"]),
        "usage_from_reports (keys given)": lambda: usage_from_reports(
            landed.scan_datasets(raw["datasets"]), landed.scan_jobs(raw["jobs"]),
            landed.scan_tasks(raw["tasks"]), landed.scan_reports(raw["reports"]),
            req_keys={"cpu": "double", "memory": "double", "queue": "string"},
            used_keys={"memory": "double", "time": "double", "node": "string"}),
    }
    for name, build in plans.items():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if "broadcasts off" in name else "10m")
        df = build()
        print(f"### {name}\n\n```\n{formatted(df)}\n```\n")
        full = io.StringIO()
        with redirect_stdout(full):
            df.explain("formatted")
        for line in full.getvalue().splitlines():
            if line.startswith(("PushedFilters", "ReadSchema")) or \
                    line.startswith("(") and ("Scan" in line or "Aggregate" in line):
                print("    " + line[:400])
        print()


if __name__ == "__main__":
    main()
