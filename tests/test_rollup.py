"""Rollup states: merging, storing, sums that do not depend on the order, long ids, strict mode, references."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridmeter.operators import quality, reports
from gridmeter.operators.rollup_store import RollupStore
from gridmeter.plans.usage_tables import usage_from_tables
from gridmeter.sources.derived import table_views
from gridmeter.sources.tables import normalize
from tests.conftest import SF_SMALL
from tests.test_plans import _plan, _without_broadcasts


@pytest.fixture(scope="module")
def stats(spark):
    """Reports with durations and memories over many magnitudes, as text ids and JSON."""
    r = random.Random(3)
    rows = []
    for i in range(3_000):
        value = r.choice([r.random(), 10 ** r.uniform(-9, 9), r.uniform(-1, 1) * 1e-6])
        rows.append((f"r{i:05d}", f"t{i % 37}", json.dumps({
            "error": r.choice([None, False, True]), "error_summary": r.choice(["Resource overusage for memory", None]),
            "time": f"2020-01-01T00:00:{i % 60:02d}", "resources": {"memory": value, "time": value / 3},
            "task_stats": {"upload": [{"size": i, "duration": value, "error": False}]}})))
    return spark.createDataFrame(rows, "task_stat_id string, task_id string, stat string")


def bits(df):
    return sorted(map(repr, df.collect()))


def test_sums_do_not_depend_on_partitioning(stats):
    """Equal bits at 1, 7 and 211 partitions, without rounding."""
    one = bits(reports.task_rollup(stats.repartition(1)))
    for parts in (7, 211):
        assert bits(reports.task_rollup(stats.repartition(parts))) == one


def test_sums_keep_what_decimals_cannot_hold(spark):
    rows = [("a", "t", '{"resources": {"memory": 1, "time": 1e300}}'), ("b", "t", '{"resources": {"memory": 1, "time": 0.5}}'),
            ("c", "u", '{"resources": {"memory": 1, "time": "NaN"}}'), ("d", "v", '{"resources": {"memory": 1}}'),
            ("e", "w", '{"resources": {"memory": 1, "time": 0.1}}'), ("f", "w", '{"resources": {"memory": 1, "time": 0.2}}')]
    got = {r["task_id"]: r["run_time"] for r in reports.task_rollup(
        spark.createDataFrame(rows, "task_stat_id string, task_id string, stat string")).collect()}
    assert got["t"] == 1e300 and got["u"] != got["u"] and got["v"] is None and got["w"] == 0.3


def test_store_equals_one_pass(spark, stats, scratch):
    """Batches in any number, compacted or not, give the bits of one pass over all reports."""
    whole = bits(reports.task_rollup(stats))
    store = RollupStore(spark, f"{scratch}/store")
    assert store.rollup() is None
    n = F.substring("task_stat_id", 2, 5).cast("int")
    for batch in range(4):
        assert store.add(stats.where(n % 4 == batch), f"b{batch}")
        if batch == 2:
            store.compact()
            assert len(store.folders()) == 1
    assert not store.add(stats, "b1")  # a batch that is there is not taken twice
    assert len(store.folders()) == 2 and bits(store.rollup()) == whole
    store.compact()
    assert bits(store.rollup()) == whole
    plan = _plan(store.rollup())
    assert "json" not in plan.lower()


def test_store_survives_a_lost_write(spark, stats, scratch, monkeypatch):
    store = RollupStore(spark, f"{scratch}/store")
    store.add(stats.where("task_id < 't2'"), "a")
    before = bits(store.rollup())
    with monkeypatch.context() as m:
        m.setattr(store, "_append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.add(stats.where("task_id >= 't2'"), "b")
    assert bits(store.rollup()) == before
    assert store.add(stats.where("task_id >= 't2'"), "b") and bits(store.rollup()) == bits(reports.task_rollup(stats))


def test_usage_from_stored_states(spark, scratch):
    tables = table_views(spark, SF_SMALL)
    store = RollupStore(spark, f"{scratch}/store")
    stat = normalize(tables).task_stat
    for batch in range(2):
        store.add(stat.where(F.col("task_stat_id") % 2 == batch), str(batch))
    assert bits(usage_from_tables(tables, rollup=store.rollup())) == bits(usage_from_tables(tables))


def test_long_ids_are_ordered_by_themselves(spark):
    """Ids beyond 15 bytes that share their first 15: the smallest one's totals."""
    doc = '{"task_stats": {"upload": [{"size": %d, "duration": 1, "error": false}]}}'
    for kind in ("binary", "string"):
        rows = [(i.encode() if kind == "binary" else i, "t", doc % n) for i, n in (
            ("x" * 16 + "b", 3 * 2 ** 30), ("x" * 16 + "a", 2 ** 30), ("x" * 16, 2 * 2 ** 30), ("y", 5 * 2 ** 30))]
        df = spark.createDataFrame([(bytearray(i) if kind == "binary" else i, t, d) for i, t, d in rows],
                                   f"task_stat_id {kind}, task_id string, stat string")
        assert reports.has_long_ids(df) and not reports.has_long_ids(df.where(F.octet_length("task_stat_id") < 16))
        assert reports.task_rollup(df).first()["output_size"] == 2.0


def test_strict_parses_once_and_joins_nothing(spark):
    """Strict mode raises from the parse that computes the figures."""
    tables = table_views(spark, SF_SMALL)
    stat = spark.createDataFrame([("s1", "T1", '{"error": false, "resources": {"memory": 1, "time": 1}}')],
                                 "task_stat_id string, task_id string, stat string")
    plan = _plan(reports.task_rollup(stat, strict=True))
    assert plan.count("from_json(") == 1 and "Join" not in plan, plan
    loose, strict = (_without_broadcasts(spark, lambda s=s: _plan(usage_from_tables(tables, strict=s))) for s in (False, True))
    assert strict.count("Join") == loose.count("Join")
    assert reports.task_rollup(stat, strict=True).count() == 1
    bad = stat.unionAll(spark.createDataFrame([("s2", "T1", '{"resources": {"memory": "lots"}}')], stat.schema))
    with pytest.raises(Exception, match="bad_resources in report s2"):
        reports.task_rollup(bad, strict=True).count()
    assert reports.task_rollup(bad).count() == 1


def test_references_of_a_parent_take_one_shuffle(spark):
    """Three references to one parent: one exchange by key; a hot, a null and a missing key."""
    parent = spark.createDataFrame([(i,) for i in range(10)], "id bigint")
    child = spark.createDataFrame([(1, 99 if i % 3 else None, i % 12) for i in range(600)], "a int, b bigint, c bigint")
    found = quality.check_references({"p": parent, "c": child}, [("c", x, "p", "id") for x in "abc"])
    plan = _without_broadcasts(spark, lambda: _plan(found))
    assert sorted(map(tuple, found.collect())) == [("c", "a", "p", 0), ("c", "b", "p", 400), ("c", "c", "p", 100)]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, plan
    nothing = quality.check_references({"p": parent.limit(0), "c": child.limit(0)}, [("c", "a", "p", "id")])
    assert [tuple(r) for r in nothing.collect()] == [("c", "a", "p", 0)]


def test_problem_counts_come_with_the_figures(spark):
    """Counts by reason from the pass that computes the rollup: one parse, no join."""
    from pyspark.sql import Observation

    from gridmeter.sources.derived import flawed_stats
    stat = flawed_stats(normalize(table_views(spark, SF_SMALL)).task_stat)
    want = {r["reason"]: r["count"] for r in reports.report_problems(stat).groupBy("reason").count().collect()}
    counts = Observation("problems")
    rollup = reports.task_rollup(stat, counts=counts)
    plan = _plan(rollup)
    assert plan.count("from_json(") == 1, plan
    got = bits(rollup)
    assert got == bits(reports.task_rollup(stat))
    assert len(want) >= 5 and counts.get == {p: want.get(p, 0) for p in reports.PROBLEMS}


def test_bucketed_tables_meet_without_a_shuffle(spark, scratch):
    """Reports, tasks and searches stored by task: no exchange on their sides."""
    import re

    from gridmeter.sources.bucketed import open_tables, store_tables
    views = table_views(spark, SF_SMALL)
    store_tables(views, f"{scratch}/t", 8)
    tables = open_tables(spark, f"{scratch}/t", 8)
    df = usage_from_tables(tables)
    plan = _without_broadcasts(spark, lambda: _plan(df))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert keys and "task_id" not in keys, plan
    assert bits(df) == bits(usage_from_tables(views))


@pytest.mark.parametrize("named", [10_000, 0])
def test_insert_by_key_index(spark, scratch, monkeypatch, named):
    """Inserts shuffle the batch alone; the index follows a table that others append to."""
    from gridmeter.operators import key_index
    from gridmeter.operators.key_index import KeyIndex
    monkeypatch.setattr(key_index, "MAX_NAMED_FILES", named)
    schema = "k bigint, j string, v int"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    made = lambda: KeyIndex(spark, f"{scratch}/table", f"{scratch}/index", ["k", "j"], frame().schema, 4)
    index = made()
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(index.insert(frame((1, "a", 5), (1, "a", 3), (2, "b", 1)))) == [(1, "a", 3), (2, "b", 1)]
    assert rows(index.insert(frame((1, "a", 0), (1, "b", 7)))) == [(1, "a", 3), (1, "b", 7), (2, "b", 1)]
    frame((9, "z", 9)).write.mode("append").parquet(f"{scratch}/table")
    again = made()  # another session's index at the same place
    assert rows(again.insert(frame((9, "z", 0), (8, "y", 8)))) == [(1, "a", 3), (1, "b", 7), (2, "b", 1), (8, "y", 8), (9, "z", 9)]
    again.follow()
    plan = _without_broadcasts(spark, lambda: _plan(again.new_rows(frame((9, "z", 0)))))
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert rows(again.insert(frame())) == rows(spark.read.parquet(f"{scratch}/table"))
