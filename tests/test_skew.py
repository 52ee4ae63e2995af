"""A task holding a third of all reports, spread over many input partitions."""

import json

from gridmeter.operators.reports import task_rollup

G = 2 ** 30


def _report(i):
    kind = i % 4
    if kind == 0:       # overuse failure
        return {"error": True, "error_summary": "Resource overusage for memory: x",
                "resources": {"memory": 2.0, "time": 0.25}, "time": "2019-01-01T00:00:00"}
    if kind == 1:       # success with one good download (size grows with i)
        return {"resources": {"memory": float(i % 97), "time": 1.0},
                "time": "2019-01-%02dT00:00:00" % (1 + i % 28),
                "task_stats": {"download": [{"size": (i + 1) * 1024, "duration": 10, "error": False}],
                               "upload": [{"size": G, "duration": 3600, "error": False}]}}
    if kind == 2:       # failed report with a transfer that does not count
        return {"error": True, "resources": {"memory": 1.0, "time": 0.5},
                "task_stats": {"download": [{"size": 5, "duration": 1, "error": True}]}}
    return {"error": False, "resources": {"memory": 3.0, "time": 2.0}}


def test_hot_task_rollup(spark):
    n_hot, n_other = 3000, 6000
    rows = [(i, 0 if i < n_hot else 1 + i % 500, json.dumps(_report(i)))
            for i in range(n_hot + n_other)]
    ts = spark.createDataFrame(rows, "task_stat_id bigint, task_id bigint, stat string") \
        .repartition(16)                                     # the hot task is in every partition
    got = {r["task_id"]: r for r in task_rollup(ts).collect()}

    hot = [_report(i) | {"id": i} for i in range(n_hot)]
    ok = [r for r in hot if "error" not in r]
    over = [r for r in hot if str(r.get("error_summary", "")).startswith("Resource overusage")]
    not_failed = [r for r in hot if r.get("error") is not True]
    with_down = [r for r in hot if any(t.get("error") is False
                                       for t in r.get("task_stats", {}).get("download", []))]
    first = min(with_down, key=lambda r: r["id"])
    g = got[0]
    assert g["n_ok"] == len(ok)
    assert g["rss"] == max(r["resources"]["memory"] for r in ok)
    assert g["evictions"] == len(over)
    assert abs(g["failed_GB_hours"] - sum(0.25 * 2.0 for _ in over)) < 1e-9
    assert abs(g["run_time"] - sum(r["resources"]["time"] for r in not_failed)) < 1e-9
    assert g["input_size"] == first["task_stats"]["download"][0]["size"] / G
    assert len(got) == 1 + 500
