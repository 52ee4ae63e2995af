"""Plan shape of the table-path query on Parquet tables."""

import re

import pytest
from pyspark.sql import functions as F

from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.sources.derived import table_views
from gridmeter.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def parquet_tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    for name, df in table_views(spark, SF_SMALL).items():
        df.write.parquet(f"{base}/{name}")
    return base, Tables(**{n: spark.read.parquet(f"{base}/{n}") for n in
                           ("task", "task_rel", "search", "job", "task_stat", "dataset")})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_single_scan_of_reports(parquet_tables):
    base, t = parquet_tables
    plan = _formatted(usage_from_tables(t))
    scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/task_stat\]", plan)
    assert len(scans) == 1, plan
    read = re.search(r"Location: InMemoryFileIndex \[[^\]]*/task_stat\]\n.*?ReadSchema: ([^\n]*)",
                     plan, re.S).group(1)
    assert "stat" in read and "task_id" in read


def test_no_python_in_plan(parquet_tables):
    _, t = parquet_tables
    plan = _formatted(usage_from_tables(t))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_status_pushed_into_scan(parquet_tables):
    _, t = parquet_tables
    plan = _formatted(usage_from_tables(t))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(task_status", plan), plan


def test_one_aggregate_over_reports(parquet_tables):
    _, t = parquet_tables
    df = usage_from_tables(t)
    plan = _formatted(df)
    # partial + final of one groupBy(task_id)
    assert len(re.findall(r"HashAggregate|ObjectHashAggregate|SortAggregate", plan)) <= 2 * 1 + 2
    assert df.count() == 23


def test_figure_by_figure_comparison_agrees(parquet_tables):
    """The bench's comparison form computes the same rows as the single pass."""
    import bench
    from gridmeter.operators.reports import task_rollup
    _, t = parquet_tables
    multi = bench.figure_by_figure(t.task_stat)
    single = task_rollup(t.task_stat).select(*multi.columns)
    assert single.exceptAll(multi).count() == 0 and multi.exceptAll(single).count() == 0


def _without_broadcasts(spark, plan_of):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_byte_ids_roll_up_in_a_hash_aggregate(spark, parquet_tables):
    """With the declared byte-string ids the rollup is one hash aggregate, partial and final."""
    import bench
    from gridmeter.operators.reports import task_rollup
    _, t = parquet_tables
    stat = t.task_stat.select(*[bench._as_bytes(c) if c in bench.ID_COLUMNS else F.col(c) for c in t.task_stat.columns])
    plan = _without_broadcasts(spark, lambda: _plan(task_rollup(stat)))
    assert plan.count("HashAggregate(") == 2 and "SortAggregate" not in plan, plan
    got = task_rollup(stat).select(F.col("task_id").cast("string").cast("bigint").alias("task_id"), "output_size", "input_size")
    want = task_rollup(t.task_stat).select("task_id", "output_size", "input_size")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_fixed_width_key_orders_like_bytes(spark):
    from gridmeter.functions.ids import fixed_width_key
    ids = [b"", b"\x00", b"\x00\x00", b"a", b"a\x00", b"ab", b"b", b"\xff" * 15, b"\xff" * 14, b"O1r99c57luMXkK", b"\x7f" * 8, b"\x80"]
    rows = spark.createDataFrame([(bytearray(i),) for i in ids], "id binary").select("id", F.expr(fixed_width_key("id")).alias("k")).collect()
    assert [bytes(r["id"]) for r in sorted(rows, key=lambda r: r["k"])] == sorted(ids)
    with pytest.raises(Exception, match="id of more than 15 bytes"):
        spark.createDataFrame([(bytearray(16),)], "id binary").select(F.expr(fixed_width_key("id"))).collect()


def test_insert_ignore_shuffles_the_batch_once(spark, parquet_tables):
    from gridmeter.operators.copy import new_rows
    _, t = parquet_tables
    plan = _without_broadcasts(spark, lambda: _plan(new_rows(t.search, t.search, ["task_id"])))
    assert plan.count("Exchange hashpartitioning") == 2, plan  # the batch once, the target's keys once


def test_usage_from_reports_is_lazy(spark, scratch):
    """Building the document query writes nothing."""
    import glob

    from gridmeter.plans.usage_reports import usage_from_reports
    from gridmeter.session import checkpoint_dir
    from gridmeter.sources import landed
    from gridmeter.sources.derived import landed_documents
    base = checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{base}/*"))
    raw = landed_documents(spark, SF_SMALL)
    df = usage_from_reports(landed.scan_datasets(raw["datasets"]), landed.scan_jobs(raw["jobs"]),
                            landed.scan_tasks(raw["tasks"]), landed.scan_reports(raw["reports"]))
    assert {"queue_req", "arch_req", "node_used"} <= set(df.columns) and set(glob.glob(f"{base}/*")) == before


def test_broadcast_checked(spark):
    from gridmeter.operators.joins import broadcast_if_small, measured_size
    df = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "k bigint, s string")
    n, nbytes = measured_size(df)
    assert n == 100 and nbytes == 100 * (8 + 8 + 8) + 100 * 10
    small = broadcast_if_small(df)
    other = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _formatted(other.join(small, "k"))
    assert broadcast_if_small(df, max_bytes=1000) is df   # too many bytes: left as is
    assert broadcast_if_small(df, max_rows=50) is df      # too many rows: left as is


def test_newest_documents_are_ranked_before_the_shuffle(spark, tmp_path):
    """No sort aggregate over listings, and one shuffle of the tasks for the ranking and the join with the figures."""
    from gridmeter.plans.usage_reports import usage_from_reports
    from gridmeter.sources import landed
    from gridmeter.sources.derived import landed_documents
    for kind, df in landed_documents(spark, SF_SMALL).items():
        df.write.json(f"{tmp_path}/{kind}")
    raw = {k: landed.read_landed(spark, str(tmp_path), k) for k in ("datasets", "tasks", "jobs", "reports")}
    df = usage_from_reports(landed.scan_datasets(raw["datasets"]), landed.scan_jobs(raw["jobs"]), landed.scan_tasks(raw["tasks"]),
                            landed.scan_reports(raw["reports"]), req_keys={"memory": "double"}, used_keys={"time": "double"})
    plan = _without_broadcasts(spark, lambda: _plan(df))
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") >= 6, plan  # three listings and reports, partial and final
    # Figures meet tasks on (dataset_id, task_id) where their ranking has put them.
    assert plan.count("Exchange hashpartitioning(dataset_id") + plan.count("Exchange hashpartitioning(coalesce") <= 6, plan
