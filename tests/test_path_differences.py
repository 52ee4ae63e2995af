"""One set of reports through both paths: each documented difference holds."""

import datetime as dt
import json

import pytest

from gridmeter.operators.documents import task_figures
from gridmeter.plans.usage_reports import usage_from_reports
from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.sources.tables import Tables

G = 2 ** 30
OVER = "Resource overusage for memory: 3"

# task -> ordered reports (stat_id, stats)
REPORTS = {
    # missing `error` on a transfer; an error report carrying transfers; a later
    # successful report: the paths pick different reports and transfers
    "A": [("a1", {"error": True, "error_summary": "Other failure", "time": "2019-01-01T01:00:00",
                  "resources": {"memory": 9, "time": 1},
                  "task_stats": {"upload": [{"size": G, "duration": 3600, "error": False}]}}),
          ("a2", {"time": "2019-01-01T02:00:00", "resources": {"memory": 4, "time": 2},
                  "site": "S", "hostname": "h",
                  "task_stats": {"download": [{"size": G, "duration": 3600}],
                                 "upload": [{"size": 2 * G, "duration": 7200, "error": False}]}})],
    # no overuse, no successful report (error false), no outputs
    "B": [("b1", {"error": False, "time": "2019-01-01T03:00:00", "resources": {"memory": 5, "time": 1},
                  "task_stats": {}})],
    # outputs only inside a string-encoded task_stats
    "C": [("c1", {"time": "2019-01-01T04:00:00", "resources": {"memory": 6, "time": 1},
                  "task_stats": json.dumps({"upload": [{"size": G, "duration": 60, "error": False}]})})],
    # an overuse report, then a success
    "D": [("d1", {"error": True, "error_summary": OVER, "time": "2019-01-01T05:00:00",
                  "resources": {"memory": 3, "time": 0.5}}),
          ("d2", {"time": "2019-01-01T06:00:00", "resources": {"memory": 2, "time": 1},
                  "task_stats": {"upload": [{"size": G, "duration": 60, "error": False}]}})],
}


@pytest.fixture(scope="module")
def both(spark):
    rel = spark.createDataFrame([("R", "ds", 0, bytearray(b"main"), '{"memory": 4}')],
                                "task_rel_id string, dataset_id string, task_index int, "
                                "name binary, requirements string")
    tasks = list(REPORTS)
    tables = Tables(
        task=spark.createDataFrame([(t, '{"memory": 8, "os": "x"}', "R") for t in tasks],
                                   "task_id string, requirements string, task_rel_id string"),
        task_rel=rel,
        search=spark.createDataFrame([(t, "J", "complete") for t in tasks],
                                     "task_id string, job_id string, task_status string"),
        job=spark.createDataFrame([("J", 0)], "job_id string, job_index int"),
        task_stat=spark.createDataFrame(
            [(sid, t, json.dumps(stats)) for t, rs in REPORTS.items() for sid, stats in rs],
            "task_stat_id string, task_id string, stat string"))
    table_rows = {r["task_id"]: r for r in usage_from_tables(tables).collect()}
    docs = spark.createDataFrame(
        [("ds", t, "{" + ",".join(f'"{sid}": {json.dumps({"stats": st})}' for sid, st in rs) + "}")
         for t, rs in REPORTS.items()], "dataset_id string, task_id string, doc string")
    datasets = spark.createDataFrame([(7, "ds")], "dataset bigint, dataset_id string")
    jobs = spark.createDataFrame([("ds", "J", 0)], "dataset_id string, job_id string, job_index int")
    listed = spark.createDataFrame(
        [("ds", "J", t, i, {"memory": "8", "os": "x"}, "complete") for i, t in enumerate(tasks)],
        "dataset_id string, job_id string, task_id string, task_index int, "
        "requirements map<string,string>, status string")
    doc_rows = {r["task_id"]: r for r in
                usage_from_reports(datasets, jobs, listed, docs, keep_task_id=True).collect()}
    figs = {r["task_id"]: r for r in task_figures(docs).collect()}
    return table_rows, doc_rows, figs


def test_transfer_with_missing_error(both):
    table_rows, doc_rows, _ = both
    assert table_rows["A"]["input_size"] is None          # excluded on the table path
    assert doc_rows["A"]["input_size"] == 1.0              # included on the document path


def test_which_report_gives_totals(both):
    table_rows, doc_rows, _ = both
    assert table_rows["A"]["output_size"] == 1.0           # smallest report id, error report too
    assert doc_rows["A"]["output_size"] == 2.0             # last report without error_summary


def test_memory_and_finish(both):
    table_rows, doc_rows, _ = both
    assert table_rows["A"]["rss"] == 4.0                   # max over successful reports
    assert table_rows["A"]["time_finished"] == dt.datetime(2019, 1, 1, 2)
    assert doc_rows["A"]["memory_used"] == 4.0             # latest report with resources
    assert doc_rows["D"]["time_finished"] == dt.datetime(2019, 1, 1, 6)


def test_no_overuse(both):
    table_rows, doc_rows, _ = both
    assert table_rows["A"]["evictions"] is None and table_rows["A"]["failed_GB_hours"] is None
    assert doc_rows["A"]["mem_wastage"] == 0.0
    assert table_rows["D"]["evictions"] == 1 and table_rows["D"]["failed_GB_hours"] == 1.5
    assert doc_rows["D"]["mem_wastage"] == 1.5


def test_tasks_dropped_or_kept(both):
    table_rows, doc_rows, _ = both
    assert "B" not in table_rows and "B" in doc_rows       # no output / no successful report
    assert doc_rows["B"]["output_size"] is None


def test_string_encoded_task_stats(both):
    table_rows, doc_rows, _ = both
    assert "C" not in table_rows                           # table path finds no outputs
    assert doc_rows["C"]["output_size"] == 1.0             # document path decodes


def test_requirements_and_site(both):
    table_rows, doc_rows, figs = both
    assert table_rows["A"]["final_rss_request"] == 8.0     # memory only
    assert doc_rows["A"]["memory_req"] == 8.0 and "os_req" not in doc_rows["A"].asDict()
    assert "site" not in table_rows["A"].asDict()
    assert (doc_rows["A"]["site"], doc_rows["A"]["hostname"]) == ("S", "h")
    assert figs["D"]["site"] is None                       # last report has none
