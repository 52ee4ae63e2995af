"""Malformed reports: routed to diagnostics by default, raised under strict."""

import json

import pytest
from pyspark.sql import functions as F

from gridmeter.operators.documents import report_diagnostics
from gridmeter.operators.reports import report_problems
from gridmeter.plans.usage_reports import usage_from_reports
from tests.test_golden import _listing


def test_document_diagnostics(spark):
    doc = json.dumps({
        "a": {"stats": {"error_summary": "Resource overusage for memory", "time": "t1"}},
        "b": {"stats": {"time": "t2"}},
        "c": {"stats": {"time": "t3", "task_stats": {"upload": [{"duration": 1}]}}},
        "d": {"stats": {"time": "t4", "task_stats": {"upload": [{"duration": 1, "error": True}]}}},
    })
    reports = spark.createDataFrame([("d", "T1", doc)], "dataset_id string, task_id string, doc string")
    got = {(r["stat_id"], r["reason"]) for r in report_diagnostics(reports).collect()}
    assert got == {("a", "overuse_without_resources"), ("b", "missing_task_stats"),
                   ("c", "transfer_missing_fields")}
    listing = _listing(spark, doc)
    assert usage_from_reports(*listing).count() == 1      # default: keep going
    with pytest.raises(Exception, match="unreadable report"):
        usage_from_reports(*listing, strict=True).collect()


def test_table_path_problems(spark):
    ts = spark.createDataFrame([
        ("s1", "T1", '{"error": "maybe", "time": "2019-01-01T00:00:00"}'),
        ("s2", "T1", '{"resources": {"memory": "lots", "time": 1}}'),
        ("s3", "T1", '{"time": "yesterday"}'),
        ("s4", "T1", "not json"),
        ("s5", "T1", '{"error": false, "resources": {"memory": 1, "time": 1}}'),
    ], "task_stat_id string, task_id string, stat string")
    got = {(r["task_stat_id"], r["reason"]) for r in report_problems(ts).collect()}
    assert got == {("s1", "bad_error_value"), ("s2", "bad_resources"), ("s3", "bad_time"),
                   ("s4", "unparseable_report")}


def test_strict(spark):
    """strict=True raises at run time on what the default routes to diagnostics."""
    doc = json.dumps({"b": {"stats": {"time": "t2"}}})          # no task_stats
    with pytest.raises(Exception, match="unreadable report"):
        usage_from_reports(*_listing(spark, doc), strict=True).collect()
    with pytest.raises(Exception, match="task without job"):
        usage_from_reports(*_listing(spark, "{}", job="J9"), strict=True).collect()
    assert usage_from_reports(*_listing(spark, doc)).count() == 1


def test_each_report_is_parsed_once_for_its_problem(spark):
    stats = spark.createDataFrame([(1, 1, '{"error":"maybe"}'), (2, 1, '{"error":true}'), (3, 2, "{")],
                                  "task_stat_id long, task_id long, stat string")
    # Text made by the plan, as a scan's is not: a filter on the reason must not copy it either.
    found = report_problems(stats.withColumn("stat", F.regexp_replace("stat", "x+", "x")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert {(r["task_stat_id"], r["reason"]) for r in found.collect()} == {(1, "bad_error_value"), (3, "unparseable_report")}
    docs = spark.createDataFrame([("a", "1", '{"9":{"stats":{}}}')], "dataset_id string, task_id string, doc string")
    found = report_diagnostics(docs)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    assert [(r["stat_id"], r["reason"]) for r in found.collect()] == [("9", "missing_task_stats")]
