"""Very long report documents, split into their reports: the figures of the whole document."""

import json

import pytest
from pyspark.sql import functions as F

from gridmeter.operators.documents import split_figures, task_figures
from gridmeter.sources import landed
from gridmeter.sources.derived import flawed_reports, landed_documents
from tests.conftest import SF_SMALL
from tests.test_plans import _plan


def rows(df):
    return sorted((repr(r.asDict()) for r in df.collect()))


@pytest.mark.parametrize("flawed", [False, True])
def test_every_document_split_gives_the_same_bits(spark, flawed):
    reports = landed.scan_reports(landed_documents(spark, SF_SMALL)["reports"])
    reports = flawed_reports(reports) if flawed else reports
    columns = [c for c in task_figures(reports).columns]
    whole, split = rows(task_figures(reports)), rows(task_figures(reports, split_above=0).select(*columns))
    assert len(whole) > 1_000 and split == whole
    lengths = reports.agg(F.expr("percentile(length(doc), 0.5)")).first()[0]
    assert rows(task_figures(reports, split_above=int(lengths)).select(*columns)) == whole


def test_golden_cases(spark):
    """Order, ties of time, missing stats, string-encoded stats, no reports, no document, no JSON."""
    over = "Resource overusage for memory"
    docs = [{}, {"b": {"stats": {"time": "t1", "resources": {"memory": 1, "time": 2}, "site": "X"}},
                 "a": {"stats": {"time": "t1", "resources": {"memory": 3, "time": 4}, "site": "Y"}}},
            {"a": {"stats": {"error_summary": over, "resources": {"memory": 0.1, "time": 3}, "site": "Z"}},
             "b": {"stats": {"error_summary": over, "resources": {"memory": 0.7, "time": 0.1}}}, "c": {"stats": None}},
            {"a": {"stats": {"task_stats": json.dumps({"upload": [{"size": 2 ** 30, "duration": 3600}]})}},
             "b": {"stats": {"task_stats": {"download": [{"size": 5, "duration": 1, "error": "false"}]}}}}, {"a": {}}, {"a": None}]
    df = spark.createDataFrame([("d", f"t{i}", json.dumps(d)) for i, d in enumerate(docs)] + [("d", "none", None), ("d", "bad", '{"a": {')],
                               "dataset_id string, task_id string, doc string")
    whole = task_figures(df)
    assert rows(split_figures(df).select(*whole.columns)) == rows(whole)


def test_a_long_document_is_worked_on_by_many_tasks(spark):
    """Tens of megabytes in one document: its reports are dealt out before they are parsed."""
    one = '"r%d": {"stats": {"time": "2020-01-%02dT00:00:00", "site": "S%d", "resources": {"memory": 1, "time": 2}, "task_stats": {"upload": [%s]}}}'
    transfer = ", ".join('{"size": 1073741824, "duration": 36}' for _ in range(40))
    doc = "{" + ", ".join(one % (i, i % 28 + 1, i, transfer) for i in range(20_000)) + "}"
    assert len(doc) > 30_000_000
    df = spark.createDataFrame([("d", "t", doc)], "dataset_id string, task_id string, doc string")
    found = task_figures(df, split_above=1_000_000)
    assert "hashpartitioning(dataset_id" in _plan(found)
    (row,) = found.collect()
    assert (row["n_reports"], row["site"], row["output_size"], row["output_duration"]) == (20_000, "S19999", 40.0, 0.4)
    assert str(row["time_finished"]) == "2020-01-28 00:00:00" and row["mem_wastage"] == 0.0


def test_reports_are_computed_once_for_split_documents(spark):
    from gridmeter import catalog
    files = catalog.queries()["usage_from_split_reports"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f]
