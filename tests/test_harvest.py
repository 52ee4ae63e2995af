"""Landed-document scans, incremental harvest, config export, streaming harvest."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from gridmeter.plans.harvest import export_configs, harvest
from gridmeter.sources import landed
from gridmeter.sources.derived import landed_documents
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landing"))
    docs = landed_documents(spark, SF_SMALL)
    for kind, df in docs.items():
        df.write.json(f"{base}/{kind}")
    # a dataset without any task: must still be recorded as harvested
    spark.createDataFrame([('{"empty": {"dataset": 29999, "dataset_id": "empty"}}',)], "doc string") \
        .write.mode("append").json(f"{base}/datasets")
    return base


def test_scan_datasets(spark, landing):
    ds = landed.scan_datasets(landed.read_landed(spark, landing, "datasets"))
    assert ds.count() == 26
    assert ds.where("dataset = 20003").first()["dataset_id"] == "3"


def test_scan_tasks(spark, landing):
    raw = landed.read_landed(spark, landing, "tasks")
    tasks = landed.scan_tasks(raw)                      # status filter at the source
    assert tasks.where(F.col("status") != "complete").count() == 0
    assert tasks.count() == 493
    assert landed.scan_tasks(raw, status=None).count() == 1500
    assert tasks.schema["requirements"].dataType.typeName() == "map"


def test_scan_jobs(spark, landing):
    jobs = landed.scan_jobs(landed.read_landed(spark, landing, "jobs"))
    assert jobs.count() == 150
    assert set(jobs.columns) == {"dataset_id", "job_id", "job_index"}


def test_scan_configs(spark, landing):
    configs = landed.scan_configs(landed.read_landed(spark, landing, "configs"))
    assert configs.count() == 25 and configs.where("config IS NULL").count() == 2


def _files(path):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{path}/dataset=*/*.parquet")}


def test_resume(spark, landing, scratch):
    out = f"{scratch}/out"
    first = harvest(spark, landing, out)
    assert first.count() == 26
    assert first.where("dataset = 29999").first()["n_rows"] == 0
    usage = spark.read.parquet(f"{out}/usage")
    n_complete = landed.scan_tasks(landed.read_landed(spark, landing, "tasks")).count()
    assert usage.count() == n_complete
    before = _files(f"{out}/usage")
    assert harvest(spark, landing, out).count() == 0          # nothing left to do
    assert _files(f"{out}/usage") == before
    again = harvest(spark, landing, out, include=[20003])       # re-harvest one dataset
    assert [r["dataset"] for r in again.collect()] == [20003]
    after = _files(f"{out}/usage")
    kept = {p: m for p, m in before.items() if "dataset=20003" not in p}
    assert all(after.get(p) == m for p, m in kept.items())
    assert spark.read.parquet(f"{out}/usage").count() == n_complete


def test_sink_partition_replace(spark, scratch):
    """Dynamic partition overwrite: rewritten datasets are replaced, others kept."""
    from gridmeter.sources.sinks import write_partitioned
    path = f"{scratch}/t"
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "dataset bigint, v string"), path)
    write_partitioned(spark.createDataFrame([(2, "c")], "dataset bigint, v string"), path)
    assert sorted(map(tuple, spark.read.parquet(path).select("dataset", "v").collect())) == \
        [(1, "a"), (2, "c")]


def test_sorted_within_dataset(spark, landing, scratch):
    out = f"{scratch}/out"
    harvest(spark, landing, out, include=[20001])
    part = spark.read.parquet(f"{out}/usage/dataset=20001").toPandas()
    keys = list(zip(part["task"], part["job"]))
    assert keys == sorted(keys)


def test_sink_configs(spark, landing, scratch):
    out = f"{scratch}/configs"
    skipped = export_configs(spark, landing, out)
    assert sorted(r["dataset_id"] for r in skipped.collect()) == ["19", "9"]
    assert spark.read.text(out).count() == 23


def test_streaming_harvest(spark, landing, scratch):
    from gridmeter.streaming import harvest_stream
    out = f"{scratch}/out"
    q = harvest_stream(spark, landing, out, checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(300)
    ledger = spark.read.parquet(f"{out}/_ledger")
    assert ledger.count() == 25          # every dataset that has report records
    q2 = harvest_stream(spark, landing, out, checkpoint=f"{scratch}/ckpt")
    q2.awaitTermination(300)              # nothing new landed: no batch
    assert q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0


def test_doc_as_embedded_object(spark, scratch):
    """A landed record whose doc is a JSON object (not a string) reads the same."""
    path = f"{scratch}/reports"
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write('{"dataset_id": "d", "task_id": "T1", "doc": {"b": {"stats": {"time": "t2", '
                '"site": "Y"}}, "a": {"stats": {"time": "t1", "site": "X"}}}}\n')
        f.write('{"dataset_id": "d", "task_id": "T2", "doc": "{\\"a\\": {\\"stats\\": {\\"site\\": \\"Z\\"}}}"}\n')
    from gridmeter.operators.documents import task_figures
    raw = landed.read_landed(spark, scratch, "reports")
    got = {r["task_id"]: r["site"] for r in task_figures(landed.scan_reports(raw)).collect()}
    assert got == {"T1": "X", "T2": "Z"}      # last report in document order


def test_landing_partitioned_by_dataset(spark, landing, scratch):
    """Listings landed under dataset_id=<id>/ folders harvest the same."""
    base = f"{scratch}/landing"
    for kind in ("tasks", "jobs", "reports"):
        landed.read_landed(spark, landing, kind).write.partitionBy("dataset_id").json(f"{base}/{kind}")
    landed.read_landed(spark, landing, "datasets").write.json(f"{base}/datasets")
    a = harvest(spark, landing, f"{scratch}/out_a")
    b = harvest(spark, base, f"{scratch}/out_b")
    assert sorted(a.collect()) == sorted(b.collect())
    assert spark.read.parquet(f"{scratch}/out_b/usage").count() == \
        spark.read.parquet(f"{scratch}/out_a/usage").count()


def test_harvest_drops_its_rows_table(spark, landing, scratch):
    from gridmeter.session import checkpoint_dir
    base = checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{base}/harvest-*"))
    harvest(spark, landing, f"{scratch}/out", include=[20002])
    made = set(glob.glob(f"{base}/harvest-*")) - before
    assert len(made) == 3 and all(spark.read.parquet(p).count() == 0 for p in made)


def test_streaming_default_checkpoint(spark, landing, scratch):
    """Without a checkpoint argument the stream keeps its state in the shared
    checkpoint folder (spark.checkpoint.dir), not next to the output."""
    from gridmeter.session import checkpoint_dir
    from gridmeter.streaming import harvest_stream
    base = checkpoint_dir(spark).replace("file:", "")
    q = harvest_stream(spark, landing, f"{scratch}/out")
    q.awaitTermination(300)
    import hashlib
    key = hashlib.sha1(f"{landing}|{scratch}/out".encode()).hexdigest()[:16]
    assert os.path.isdir(f"{base}/harvest_stream-{key}/offsets")
    assert spark.read.parquet(f"{scratch}/out/_ledger").count() == 25


def _land(spark, base, kind, rows):
    """One more landed file of a kind."""
    from gridmeter.schemas import LANDED
    spark.createDataFrame([{**r, "landed_at": None} for r in rows], LANDED[kind]).coalesce(1).write.mode("append").json(f"{base}/{kind}")


def _task(status="complete", memory=1):
    return ('{"t1": {"dataset_id": "d", "job_id": "j", "task_id": "t1", "task_index": 0, "requirements": {"memory": %d}, '
            '"status": "%s"}}' % (memory, status))


def _report(hours):
    return '{"r1": {"stats": {"time": "2019-01-01T00:00:00", "resources": {"time": %s}, "task_stats": {}}}}' % hours


def test_relanded_records_count_once(spark, scratch):
    base, out = f"{scratch}/landing", f"{scratch}/out"
    _land(spark, base, "datasets", [{"doc": '{"d": {"dataset": 1, "dataset_id": "d"}}'}])
    _land(spark, base, "tasks", [{"dataset_id": "d", "doc": _task()}])
    _land(spark, base, "jobs", [{"dataset_id": "d", "doc": '{"j": {"job_index": 4}}'}])
    _land(spark, base, "reports", [{"dataset_id": "d", "task_id": "t1", "doc": _report(1.0)}])
    harvest(spark, base, out)
    assert [r["time_used"] for r in spark.read.parquet(f"{out}/usage").collect()] == [1.0]
    # A report, then the listings land again.
    _land(spark, base, "reports", [{"dataset_id": "d", "task_id": "t1", "doc": _report(2.0)}])
    harvest(spark, base, out, include=[1])
    assert [r["time_used"] for r in spark.read.parquet(f"{out}/usage").collect()] == [2.0]
    _land(spark, base, "datasets", [{"doc": '{"d": {"dataset": 1, "dataset_id": "d"}}'}])
    _land(spark, base, "tasks", [{"dataset_id": "d", "doc": _task(memory=7)}])
    assert harvest(spark, base, out, include=[1]).count() == 1
    assert [r["memory_req"] for r in spark.read.parquet(f"{out}/usage").collect()] == [7.0]
    assert spark.read.parquet(f"{out}/_ledger").count() == 1
    # The dataset's only task is no longer complete: its rows go.
    _land(spark, base, "tasks", [{"dataset_id": "d", "doc": _task(status="queued")}])
    assert [r["n_rows"] for r in harvest(spark, base, out, include=[1]).collect()] == [0]
    assert spark.read.parquet(f"{out}/usage").count() == 0


@pytest.mark.parametrize("literals", [1_000, 0])
def test_task_documents_name_their_dataset(spark, scratch, monkeypatch, literals):
    """Task records whose own dataset id is null or another: the document's counts, as in usage_from_reports."""
    from gridmeter.plans import harvest as plan
    monkeypatch.setattr(plan, "MAX_LITERAL_IDS", literals)
    base, out = f"{scratch}/landing", f"{scratch}/out"
    _land(spark, base, "datasets", [{"doc": '{"d": {"dataset": 1, "dataset_id": "d"}, "e": {"dataset": 2, "dataset_id": "e"}}'}])
    task = '{"%s": {%s"job_id": "j", "task_id": "%s", "task_index": 0, "requirements": {}, "status": "complete"}}'
    _land(spark, base, "tasks", [{"dataset_id": o, "doc": task % (t, f'"dataset_id": "{i}", ' if i else "", t)} for o, i, t in (
        (None, "d", "t1"), ("e", "d", "t2"), ("gone", "d", "t3"), ("d", None, "t4"), ("d", "e", "t5"), (None, None, "t6"))])
    _land(spark, base, "jobs", [{"dataset_id": d, "doc": '{"j": {"job_index": 4}}'} for d in "de"])
    _land(spark, base, "reports", [{"dataset_id": "d", "task_id": "t1", "doc": _report(1.0)}])
    got = harvest(spark, base, out, include=[1]).collect()
    assert [(r["dataset"], r["n_tasks"], r["n_rows"]) for r in got] == [(1, 4, 4)]
    got = harvest(spark, base, out).collect()
    assert [(r["dataset"], r["n_tasks"], r["n_rows"]) for r in got] == [(2, 1, 1)]


def test_ledger_rows_stay_a_table(spark, scratch):
    """The result is read from a written table, not from rows of the driver, also after further harvests."""
    base, out = f"{scratch}/landing", f"{scratch}/out"
    _land(spark, base, "datasets", [{"doc": '{"d": {"dataset": 1, "dataset_id": "d"}}'}])
    _land(spark, base, "tasks", [{"dataset_id": "d", "doc": _task()}])
    _land(spark, base, "jobs", [{"dataset_id": "d", "doc": '{"j": {"job_index": 4}}'}])
    _land(spark, base, "reports", [{"dataset_id": "d", "task_id": "t1", "doc": _report(1.0)}])
    first = harvest(spark, base, out)
    assert first.inputFiles()
    _land(spark, base, "tasks", [{"dataset_id": "d", "doc": _task(status="queued")}])
    second = harvest(spark, base, out, include=[1])
    assert [tuple(r) for r in first.collect()] == [(1, 1, 1, 1)]
    assert [tuple(r) for r in second.collect()] == [(1, 0, 1, 0)] == [
        tuple(r) for r in spark.read.parquet(f"{out}/_ledger").select(second.columns).collect()]
    assert second.schema == first.schema and [f.dataType.typeName() for f in second.schema] == ["long"] * 4


def test_unreadable_records_are_listed_and_strict_raises(spark, scratch):
    base = f"{scratch}/landing"
    os.makedirs(f"{base}/tasks")
    with open(f"{base}/tasks/a.jsonl", "w") as f:
        f.write('{"dataset_id": "d", "doc": "{\\"t1\\": {"}\n{"dataset_id": "d", "do\n')
    raw = landed.read_landed(spark, base, "tasks")
    assert sorted(r["reason"] for r in landed.corrupt_records(raw, "tasks").collect()) == ["corrupt_document", "corrupt_line"]
    with pytest.raises(Exception, match="unreadable record in tasks"):
        landed.scan_tasks(landed.checked(raw, "tasks")).collect()


def test_work_list_prunes_landed_partitions(spark, landing, scratch):
    """With listings landed under dataset_id=... folders a filtered scan reads only their files."""
    from gridmeter.plans.harvest import of_datasets
    for kind in ("tasks", "jobs", "reports"):
        landed.read_landed(spark, landing, kind).drop("landed", "_corrupt").write.partitionBy("dataset_id").json(f"{scratch}/{kind}")
        raw = landed.read_landed(spark, scratch, kind)
        one = of_datasets(raw, None, ["3"])
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dataset_id" in plan or "PartitionFilters: [(dataset_id" in plan, plan
        assert one.count() == raw.where("dataset_id = '3'").count() > 0


def _one_dataset(spark, base, dataset, requirements):
    """A dataset with one completed task of the given requirements lands."""
    d = f"d{dataset}"
    _land(spark, base, "datasets", [{"doc": '{"%s": {"dataset": %d, "dataset_id": "%s"}}' % (d, dataset, d)}])
    _land(spark, base, "tasks", [{"dataset_id": d, "doc": '{"t%d": {"dataset_id": "%s", "job_id": "j", "task_id": "t%d", "task_index": 0, '
                                  '"requirements": %s, "status": "complete"}}' % (dataset, d, dataset, requirements)}])
    _land(spark, base, "jobs", [{"dataset_id": d, "doc": '{"j": {"job_index": 4}}'}])
    _land(spark, base, "reports", [{"dataset_id": d, "task_id": f"t{dataset}", "doc": _report(1.0)}])


def test_key_that_becomes_text(spark, scratch):
    """A key is a number in one run and text in the next: the table reads as one, with the first text kept."""
    from gridmeter.sources.sinks import read_usage
    base, out = f"{scratch}/landing", f"{scratch}/out"
    assert read_usage(spark, out) is None
    _one_dataset(spark, base, 1, '{"gpu": 1, "memory": 2}')
    harvest(spark, base, out)
    _one_dataset(spark, base, 2, '{"cpu": 3}')
    harvest(spark, base, out)
    assert read_usage(spark, out).schema["gpu_req"].dataType.typeName() == "double"
    kept = _files(f"{out}/usage")
    _one_dataset(spark, base, 3, '{"gpu": "A100", "memory": 5}')
    harvest(spark, base, out)
    got = {r["dataset"]: (r["gpu_req"], r["memory_req"], r["cpu_req"]) for r in read_usage(spark, out).collect()}
    assert got == {1: ("1", 2.0, None), 2: (None, None, 3.0), 3: ("A100", 5.0, None)}
    # Also without the registry, by the files' own schemas.
    merged = spark.read.option("mergeSchema", "true").parquet(f"{out}/usage")
    assert merged.schema["gpu_req"].dataType.typeName() == "string" and merged.count() == 3
    assert set(kept) & set(_files(f"{out}/usage")) == set()
    # A number again stays text, and nothing is written again.
    kept = _files(f"{out}/usage")
    _one_dataset(spark, base, 4, '{"gpu": 8}')
    harvest(spark, base, out)
    assert {r["gpu_req"] for r in read_usage(spark, out).where("dataset = 4").collect()} == {"8"}
    assert all(_files(f"{out}/usage").get(p) == m for p, m in kept.items())
    ledger = {r["dataset"]: r["run"] for r in spark.read.parquet(f"{out}/_ledger").collect()}
    assert ledger == {1: 3, 2: 3, 3: 3, 4: 4}


def test_widening_survives_a_lost_run(spark, scratch, monkeypatch):
    """A run that fails after it registered a text key: the next run mends the older files."""
    from gridmeter.sources import sinks
    base, out = f"{scratch}/landing", f"{scratch}/out"
    _one_dataset(spark, base, 1, '{"gpu": 1}')
    harvest(spark, base, out)
    _one_dataset(spark, base, 2, '{"gpu": "A100"}')
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_usage", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            harvest(spark, base, out)
    assert [r["dataset"] for r in harvest(spark, base, out).collect()] == [2]
    assert sorted((r["dataset"], r["gpu_req"]) for r in sinks.read_usage(spark, out).collect()) == [(1, "1"), (2, "A100")]


def test_given_key_types_meet_the_registry(spark, scratch):
    from gridmeter.sources.sinks import read_usage
    base, out = f"{scratch}/landing", f"{scratch}/out"
    _one_dataset(spark, base, 1, '{"gpu": "A100", "memory": 2}')
    harvest(spark, base, out)
    _one_dataset(spark, base, 2, '{"gpu": 1, "memory": 3}')
    harvest(spark, base, out, req_keys={"gpu": "double"}, used_keys=["time"])
    assert sorted((r["dataset"], r["gpu_req"], r["memory_req"]) for r in read_usage(spark, out).collect()) == [(1, "A100", 2.0), (2, "1", None)]


def test_harvest_of_one_dataset_opens_its_files_alone(spark, landing, scratch):
    """The frames that harvest builds from: all kinds, by the file index."""
    from gridmeter.plans.harvest import landed_inputs, listed_datasets
    from gridmeter.sources import file_index, sinks
    base = f"{scratch}/landing"
    for kind in ("tasks", "jobs", "reports"):
        landed.read_landed(spark, landing, kind).drop("landed", "_corrupt").repartition("dataset_id").write.partitionBy("dataset_id").json(f"{base}/{kind}")
    for i in range(25):
        _land(spark, base, "datasets", [{"doc": '{"%d": {"dataset": %d, "dataset_id": "%d"}}' % (i, 20000 + i, i)}])
    index = file_index.refresh(spark, base, f"{scratch}/files")
    done = sinks.read_ledger(spark, f"{scratch}/none")
    work = listed_datasets(spark, base, index, [20003], done)
    assert len(work.inputFiles()) == 1 and [tuple(r) for r in work.collect()] == [(20003, "3")]
    found = landed_inputs(spark, base, index, work.select("dataset_id"), ["3"])
    for kind in ("tasks", "jobs", "reports"):
        files = found[kind].inputFiles()
        assert files and all("dataset_id=3/" in f for f in files), kind
    assert found["tasks"].count() == landed.scan_tasks(landed.read_landed(spark, landing, "tasks")).where("dataset_id = '3'").count()


def test_file_index_reads_only_new_files(spark, scratch):
    from gridmeter.sources import file_index
    base, path = f"{scratch}/landing", f"{scratch}/files"
    _one_dataset(spark, base, 1, "{}")
    assert file_index.refresh(spark, base, path).count() == 4
    before = _index_files(path)
    assert file_index.refresh(spark, base, path).count() == 4 and _index_files(path) == before
    _land(spark, base, "tasks", [{"dataset_id": "d1", "doc": '{"x": {"dataset_id": "d2"}, "y": {}}'}])
    rows = file_index.refresh(spark, base, path).where("kind = 'tasks'").collect()
    assert sorted((r["dataset_id"], r["foreign"]) for r in rows) == [("d1", False), ("d1", False), ("d2", True)]


def _index_files(path):
    return sorted(glob.glob(f"{path}/*.parquet"))


def test_more_files_than_are_named(spark, scratch, monkeypatch):
    """Beyond the limit of named files the chosen ones are a join on the file; the same rows."""
    from gridmeter.sources import file_index
    base, out = f"{scratch}/landing", f"{scratch}/out"
    for d in (1, 2, 3):
        _one_dataset(spark, base, d, '{"memory": %d}' % d)
    monkeypatch.setattr(file_index, "MAX_NAMED_FILES", 0)
    harvest(spark, base, out, include=[2])
    assert [(r["dataset"], r["memory_req"]) for r in spark.read.parquet(f"{out}/usage").collect()] == [(2, 2.0)]


def test_other_dataset_is_listed_and_strict_raises(spark, scratch):
    base = f"{scratch}/landing"
    _land(spark, base, "tasks", [{"dataset_id": "e", "doc": _task()}, {"dataset_id": "d", "doc": _task()}, {"dataset_id": None, "doc": _task()}])
    raw = landed.read_landed(spark, base, "tasks")
    assert [r["reason"] for r in landed.corrupt_records(raw, "tasks").collect()] == ["other_dataset"]
    with pytest.raises(Exception, match="unreadable record in tasks"):
        landed.checked(raw, "tasks").collect()


def test_text_form_of_task_stats_only_where_a_report_holds_it(spark):
    from gridmeter.sources.derived import report_stats
    plan = report_stats(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan[:plan.index(" AS wrapped#")].endswith(" END")


def test_both_landings_take_their_reports_from_one_computation(spark, monkeypatch):
    from gridmeter.catalog import documents_q
    names = []

    def stored(df, name, **more):
        names.append(name)
        raise InterruptedError(name)

    monkeypatch.setattr(documents_q, "materialize", stored, raising=False)
    with pytest.raises(InterruptedError):
        documents_q.q_harvest_key_types(spark, "/root/testdata/sf0.001")
    assert names == ["key-types-reports"]


def test_landed_files_of_a_large_dataset_are_several(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from gridmeter.catalog import documents_q
    plans = []

    def partition_by(self, *columns):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        raise InterruptedError

    monkeypatch.setattr(DataFrameWriter, "partitionBy", partition_by)
    with pytest.raises(InterruptedError):
        documents_q.q_harvest_one_dataset(spark, "/root/testdata/sf0.001")
    assert "RebalancePartitions" in plans[0]
