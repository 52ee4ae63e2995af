"""Mixing: targets, quotas, the splitting tree, whole runs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridmeter.llm import mixing, queries
from tests.llm.conftest import SF, odd_rows


def fill(sizes, weights, most):
    """Shares by weight, capped; the excess reshared until none is above."""
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        rest = {s: w for s, w in weights.items() if s not in capped}
        if not rest:
            return capped
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def test_query_targets_and_sums(spark, docs):
    got = queries.op2_mixing(spark, SF).collect()
    assert len(got) == docs.count()
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    names = sorted(sizes)
    want = fill(sizes, {s: i % 3 + 1 for i, s in enumerate(names)}, 3)
    for s in names:
        assert target[s] == pytest.approx(want[s])
        biggest = max(r["size"] for r in got if source[r["doc_id"]] == s)
        assert abs(taken[s] - target[s]) <= biggest / 2 + 1
    again = {r["doc_id"]: r["taken"] for r in queries.op2_mixing(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 1000, "c": 5, "d": 0}, {"a": 7}, {"a": 0, "b": 0}])
def test_water_filling(spark, sizes):
    weights = {s: float(i % 3 + 1) for i, s in enumerate(sorted(sizes))}
    df = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "s string, size long, weight double")
    got = {r["s"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(fill(sizes, weights, 3))


def test_hypergeometric_distribution(spark):
    n, good, bad, draws = 20_000, 12, 18, 10
    rows = spark.range(n).selectExpr(f"{good}L good", f"{bad}L bad", f"{draws}L draws", f"(id + 0.5D) / {n} u")
    seen = Counter(r["k"] for r in rows.select(F.expr(mixing.hypergeometric("good", "bad", "draws", "u")).alias("k")).collect())
    from math import comb
    for k in range(draws + 1):
        want = comb(good, k) * comb(bad, draws - k) / comb(good + bad, draws)
        assert seen[k] / n == pytest.approx(want, abs=2 / n)


@pytest.mark.parametrize("args", [(0, 0, 0), (5, 0, 3), (0, 5, 3), (5, 5, 0), (5, 5, 10), (10**9, 10**9, 10**9)])
def test_hypergeometric_bounds(spark, args):
    good, bad, draws = args
    rows = spark.range(50).selectExpr(f"{good}L good", f"{bad}L bad", f"{draws}L draws", "id / 49.0D u")
    for r in rows.select(F.expr(mixing.hypergeometric("good", "bad", "draws", "u")).alias("k")).collect():
        assert max(0, draws - bad) <= r["k"] <= min(draws, good)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_tree_shares_out_every_block_once(spark, shards):
    quotas = {"a": 37, "b": 0, "c": 5, "d": 101}
    df = spark.createDataFrame([((s,), q) for s, q in quotas.items()], "s struct<source:string>, quota long")
    rows = mixing.split_tree(df, shards, 42).collect()
    per_source, per_shard = Counter(), Counter()
    for r in rows:
        per_source[r["s"]["source"]] += r["n"]
        per_shard[r["shard"]] += r["n"]
        assert r["n"] >= 0
    assert per_source == Counter(quotas) and len(per_shard) == shards
    assert max(per_shard.values()) - min(per_shard.values()) <= shards


def test_mix_odd_rows(odd):
    mixed = mixing.mix(odd, shards=4)
    rows = mixed.collect()
    assert len(rows) == len(odd_rows())
    assert all(r["mix_size"] == 0 for r in rows if r["text"] is None)
    assert all(len(r["mix_places"]) <= 3 for r in rows)
    out = mixing.mixed_rows(mixed)
    assert set(odd.columns) - {"mix_size"} <= set(out.columns)
    assert out.count() == sum(len(r["mix_places"]) for r in rows)


def test_mix_leaves_other_columns_alone(spark):
    """Columns named like those inside keep their values; `mix_shard` is the mix's own."""
    names = ["_block", "_blocks", "got", "_p", "_place", "__block", "__blocks", "__got", "__place", "__taken", "s", "copies", "mix_shard"]
    df = spark.createDataFrame([(i, f"one two three {i}", "a" if i % 2 else None, *[f"{n}{i}" for n in names]) for i in range(20)],
                               f"doc_id bigint, text string, source string, {', '.join(f'{n} string' for n in names)}")
    mixed = mixing.mix(df, shards=4)
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in mixed.collect()} == {i: tuple(f"{n}{i}" for n in names) for i in range(20)}
    out = mixing.mixed_rows(mixed).collect()
    assert out and all(r[n] == f"{n}{r['doc_id']}" for r in out for n in names[:-1]) and {type(r["mix_shard"]) for r in out} == {int}


def test_mix_given_weights(spark, docs):
    weights = spark.createDataFrame([("src0", 1.0), ("src1", 1.0)], "source string, weight double")
    rows = mixing.mix(docs, weights).select("source", "mix_places").collect()
    assert {r["source"] for r in rows if r["mix_places"]} == {"src0", "src1"}


def test_mix_empty(empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_rows(mixing.mix(empty)).count() == 0
