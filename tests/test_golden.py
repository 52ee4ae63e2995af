"""Golden fixtures: one task per NULL / edge rule, both paths (FIXTURES.md §2)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridmeter.operators.documents import task_figures
from gridmeter.plans.usage_reports import usage_from_reports
from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.sources.tables import Tables

G = 2 ** 30
U = {"upload": [{"size": 2 * G, "duration": 7200, "error": False}]}
OVER = "Resource overusage for memory: 4.2"


def t(h):
    return f"2019-01-01T{h:02d}:00:00"


def rep(**kw):
    return json.dumps(kw)


def golden_tables(spark):
    b = lambda s: bytearray(s.encode())
    task_rel = spark.createDataFrame([
        ("R1", b("O1r99c57luMXkK"), 0, b("detector"), '{"memory":4}'),
        ("R2", b("O1r99c57luMXkK"), 1, b("filter"), '{"memory":"$eval(2)"}'),
        ("R3", b("O1r99c57luMXkK"), 2, b("merge"), "{}"),
    ], "task_rel_id string, dataset_id binary, task_index int, name binary, requirements string")
    spec = {  # task: (rel, requirements, status)
        "T1": ("R1", '{"memory":6}', "complete"), "T2": ("R1", "", "complete"),
        "T3": ("R2", "", "complete"), "T4": ("R3", "", "complete"),
        "T5": ("R1", "", "failed"), "T6": ("R1", "", "complete"),
        "T7": ("R1", '{"memory":null}', "complete"), "T8": ("R1", "", "complete"),
        "T9": ("R1", "", "complete"),
    }
    task = spark.createDataFrame([(k, v[1], v[0]) for k, v in spec.items()],
                                 "task_id string, requirements string, task_rel_id string")
    search = spark.createDataFrame(
        [(k, "J" + k[1:], b("O1r99c57luMXkK"), b({"R1": "detector", "R2": "filter", "R3": "merge"}[v[0]]), b(v[2]))
         for k, v in spec.items()],
        "task_id string, job_id string, dataset_id binary, name binary, task_status binary")
    job = spark.createDataFrame([(f"J{i}", i - 1) for i in range(1, 10)],
                                "job_id string, job_index int")
    plain = {"resources": {"memory": 3, "time": 1}, "task_stats": U}
    stats = [
        ("s01", "T1", rep(error=True, error_summary=OVER, resources={"memory": 4.2, "time": 0.5},
                          time=t(1))),
        ("s02", "T1", rep(resources={"memory": 5, "time": 2}, time=t(3), task_stats={
            "download": [{"size": G, "duration": 3600, "error": False},
                         {"size": G // 2, "duration": 1800, "error": True},
                         {"size": G // 4, "duration": 900}], **U})),
        ("s03", "T2", rep(error=False, time=t(2), **plain)),
        ("s04", "T3", rep(time=t(2), **plain)),
        ("s05", "T4", rep(time=t(2), **plain)),
        ("s06", "T5", rep(time=t(2), **plain)),
        ("s07", "T6", rep(time=t(5), **plain)),
        ("s08", "T7", rep(time=t(6), **plain)),
        ("s09", "T8", rep(time=t(7), resources={"memory": 3, "time": 1}, task_stats={
            "upload": [{"size": 0, "duration": 1, "error": False}]})),
        ("s10", "T9", rep(time=t(8), **plain)),
        ("s11", "T9", rep(time=t(9), resources={"memory": 8, "time": 2}, task_stats={
            "upload": [{"size": G, "duration": 3600, "error": False}]})),
    ]
    task_stat = spark.createDataFrame(stats, "task_stat_id string, task_id string, stat string")
    return Tables(task=task, task_rel=task_rel, search=search, job=job, task_stat=task_stat)


def test_usage_from_tables_golden(spark):
    rows = {r["task_id"]: r for r in usage_from_tables(golden_tables(spark)).collect()}
    assert sorted(rows) == ["T1", "T6", "T7", "T9"]
    r = rows["T1"]
    assert r["dataset_id"] == 20014 and r["task_name"] == "detector" and r["job_index"] == 0
    assert (r["input_size"], r["input_duration"]) == (1.0, 1.0)
    assert (r["output_size"], r["output_duration"]) == (2.0, 2.0)
    assert (r["rss"], r["run_time"]) == (5.0, 2.0)
    assert r["time_finished"] == dt.datetime(2019, 1, 1, 3)
    assert (r["initial_rss_request"], r["final_rss_request"]) == (4.0, 6.0)
    assert r["evictions"] == 1 and r["mean_ttf"] == 0.5
    assert r["failed_GB_hours"] == pytest.approx(2.1)
    r = rows["T6"]
    assert r["input_size"] is None and r["input_duration"] is None
    assert (r["rss"], r["run_time"], r["final_rss_request"]) == (3.0, 1.0, 4.0)
    assert r["evictions"] is None and r["mean_ttf"] is None and r["failed_GB_hours"] is None
    assert rows["T7"]["final_rss_request"] is None
    assert rows["T7"]["time_finished"] == dt.datetime(2019, 1, 1, 6)
    r = rows["T9"]
    assert (r["output_size"], r["output_duration"]) == (2.0, 2.0)  # smallest report id
    assert (r["rss"], r["run_time"]) == (8.0, 3.0)
    assert r["time_finished"] == dt.datetime(2019, 1, 1, 9)
    assert r["job_index"] == 8


def test_usage_slice_golden(spark):
    # The slice takes its tasks first; T2 and T5 among them give no row.
    for limit, want in ((2, ["T1"]), (4, ["T1", "T6"])):
        df = usage_from_tables(golden_tables(spark), dataset="O1r99c57luMXkK", name="detector",
                               limit=limit)
        assert sorted(r["task_id"] for r in df.collect()) == want


# ----------------------------------------------------------------- document path

A = {"stats": {"error": True, "error_summary": OVER, "site": "X", "hostname": "h1",
               "time": t(1), "resources": {"memory": 4.2, "time": 0.5}}}
B_TS = {"download": [{"size": G, "duration": 3600, "error": False},
                     {"size": G // 4, "duration": 900}]}


def b_doc(as_string):
    return {"stats": {"site": "Y", "time": t(3), "resources": {"memory": 5.0, "time": 2.0, "cpu": 1},
                      "task_stats": json.dumps(B_TS) if as_string else B_TS}}


def figures(spark, doc_text):
    df = spark.createDataFrame([("d", "T1", doc_text)], "dataset_id string, task_id string, doc string")
    return task_figures(df).collect()[0]


@pytest.mark.parametrize("as_string", [True, False])
def test_report_document_ab(spark, as_string):
    doc = '{"a": %s, "b": %s}' % (json.dumps(A), json.dumps(b_doc(as_string)))
    r = figures(spark, doc)
    assert (r["site"], r["hostname"]) == ("Y", None)
    assert r["time_finished"] == dt.datetime(2019, 1, 1, 3)
    assert {k: float(v) for k, v in r["used"].items()} == {"memory": 5.0, "time": 2.0, "cpu": 1.0}
    assert r["mem_wastage"] == pytest.approx(2.1)
    assert (r["input_size"], r["input_duration"]) == (1.25, 1.25)
    assert r["output_size"] is None


def test_report_document_order_ba(spark):
    doc = '{"b": %s, "a": %s}' % (json.dumps(b_doc(True)), json.dumps(A))
    r = figures(spark, doc)
    assert (r["site"], r["hostname"]) == ("X", "h1")
    assert r["time_finished"] == dt.datetime(2019, 1, 1, 3)
    assert (r["input_size"], r["input_duration"]) == (1.25, 1.25)


def test_report_document_tie_first_wins(spark):
    mk = lambda m: {"stats": {"time": t(4), "resources": {"memory": m, "time": 1}}}
    r = figures(spark, json.dumps({"a": mk(1), "b": mk(2)}))
    assert float(r["used"]["memory"]) == 1.0
    assert r["time_finished"] == dt.datetime(2019, 1, 1, 4)
    assert r["mem_wastage"] == 0.0 and r["site"] is None and r["input_size"] is None


def test_report_document_empty(spark):
    r = figures(spark, "{}")
    assert r["used"] is None and r["time_finished"] is None and r["site"] is None
    assert r["mem_wastage"] == 0.0 and r["n_reports"] == 0


def _listing(spark, doc, reqs='{"memory":4,"os":"linux"}', status="complete", job="J1"):
    datasets = spark.createDataFrame([(20014, "d")], "dataset bigint, dataset_id string")
    jobs = spark.createDataFrame([("d", "J1", 0)], "dataset_id string, job_id string, job_index int")
    tasks = spark.createDataFrame(
        [("d", job, "T1", 0, json.loads(reqs), status)],
        "dataset_id string, job_id string, task_id string, task_index int, "
        "requirements map<string,string>, status string")
    reports = spark.createDataFrame([("d", "T1", doc)], "dataset_id string, task_id string, doc string")
    return datasets, jobs, tasks, reports


def test_usage_from_reports_row(spark):
    doc = '{"a": %s, "b": %s}' % (json.dumps(A), json.dumps(b_doc(True)))
    rows = usage_from_reports(*_listing(spark, doc)).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert (r["dataset"], r["task"], r["job"]) == (20014, 0, 0)
    assert r["memory_req"] == 4.0 and "os_req" not in r
    assert (r["memory_used"], r["time_used"], r["cpu_used"]) == (5.0, 2.0, 1.0)
    assert r["input_size"] == 1.25 and r["output_size"] is None  # row kept without outputs


def test_usage_from_reports_missing_job(spark):
    listing = _listing(spark, "{}", job="J404")
    assert usage_from_reports(*listing).count() == 0
    with pytest.raises(Exception, match="task without job"):
        usage_from_reports(*listing, strict=True).collect()


def test_path_differences(spark):
    """Same reports through both paths: the documented differences hold."""
    doc = '{"s01": %s, "s02": %s}' % (
        json.dumps({"stats": json.loads(golden_tables(spark).task_stat.where("task_stat_id='s01'")
                                        .first()["stat"])}),
        json.dumps({"stats": json.loads(golden_tables(spark).task_stat.where("task_stat_id='s02'")
                                        .first()["stat"])}))
    r = figures(spark, doc)
    # document path: missing error counts, so the G/4 download is included
    assert r["input_size"] == 1.25
    # table path: only error=false counts
    t1 = usage_from_tables(golden_tables(spark)).where("task_id = 'T1'").first()
    assert t1["input_size"] == 1.0
    # no-overuse reading: table path NULL, document path 0.0
    t6 = usage_from_tables(golden_tables(spark)).where("task_id = 'T6'").first()
    assert t6["failed_GB_hours"] is None
    assert figures(spark, '{"x": {"stats": {"time": "t"}}}')["mem_wastage"] == 0.0


def test_discover_keys_of(spark):
    from gridmeter.operators.pivot import discover_keys, discover_keys_of
    df = spark.createDataFrame([({"a": "1"}, {"x": "2"}), ({"b": "1"}, None), (None, {"y": "3"})],
                               "r map<string,string>, u map<string,string>")
    assert {c: sorted(k) for c, k in discover_keys_of({"r": df.select("r"), "u": df.select("u")}).items()} == {
        "r": ["a", "b"], "u": ["x", "y"]}
    assert sorted(discover_keys(df, "r")) == ["a", "b"]


def test_transfer_error_truthiness(spark):
    """Document path: a transfer is good unless its error value is truthy."""
    errors = ['false', '"false"', '0', '"0"', '""', '"x"', '[]', '[1]', '{}', 'null', '1', '0.0', None]
    good = {'false', '0', '""', '[]', '{}', 'null', '0.0', None}
    records = ",".join(
        '{"size": %d, "duration": 1%s}' % (2 ** i, "" if e is None else ', "error": ' + e)
        for i, e in enumerate(errors))
    doc = '{"s": {"stats": {"time": "t", "task_stats": {"download": [%s]}}}}' % records
    expected = sum(2 ** i for i, e in enumerate(errors) if e in good) / 2 ** 30
    assert figures(spark, doc)["input_size"] == expected
