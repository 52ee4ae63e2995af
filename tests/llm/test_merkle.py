"""The manifest against a recursive computation in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridmeter.llm import merkle, queries
from tests.llm.conftest import DOCS, table

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, arity):
    """(root, path of each node: per level its siblings before and after it)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, w in enumerate(where):
            at = w // arity * arity
            paths[i].append((nodes[at:w], nodes[w + 1:at + arity]))
        nodes = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        where = [w // arity for w in where]
    return nodes[0], paths


def brute(rows, arity=16):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified) of all rows."""
    trees = defaultdict(list)
    for r in rows:
        trees[None if r[1] is None else r[1].encode()].append(r)
    order = sorted(trees, key=lambda s: (s is not None, s or b""))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    built = {s: climb([leaf(r) for r in trees[s]], arity) for s in order}
    root, tops = climb([built[s][0] for s in order], arity) if order else (None, [])
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = []
    for s, top in zip(order, tops, strict=True):
        for r, own in zip(trees[s], built[s][1], strict=True):
            path = own + top
            now = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = leaf((*r[:4], r[4].translate(lower)))
            for left, right in path:
                now = h(*left, now, *right)
            out.append((r[0], leaf(r), built[s][0], root, h(*[x for a, b in path for x in a + b]), now, now == root))
    return sorted(out, key=repr)


def answer(spark, tmp, df):
    found = queries.op12_merkle(spark, table(str(tmp), "documents", df))
    return sorted(map(tuple, found.collect()), key=repr)


def test_query_equals_recursion(spark, docs, tmp_path):
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    got = answer(spark, tmp_path, docs)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(rows) / 3


def test_odd_rows(spark, odd, tmp_path):
    """Null in every column, repeated rows, long texts, clashing names: same as the recursion."""
    assert answer(spark, tmp_path, odd) == brute([tuple(r) for r in odd.select(*COLUMNS).collect()])


def test_empty_table(spark, empty, tmp_path):
    assert answer(spark, tmp_path, empty) == []


def test_one_row_is_its_own_root(spark, tmp_path):
    one = spark.createDataFrame([(3, "Text", "en", "a", 4)], DOCS)
    (row,) = answer(spark, tmp_path, one)
    assert row[1] == row[2] == row[3] == leaf((3, "a", "en", 4, "Text")) and row[4] == h()


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    """XOR siblings of a binary tree, slot offsets of a ternary one; a hot group over many partitions."""
    rows = [(i, None if i % 9 == 0 else "hot" if i % 3 else f"s{i % 4}", "en", i, f"Text {i}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(7)
    found = merkle.manifest(df, [F.col(c) for c in COLUMNS], arity=arity)
    folded = merkle.text_of(merkle.folded(F.col("path"), F.col("leaf")))
    got = found.select("doc_id", *[merkle.text_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof"), folded.alias("folded")).collect()
    want = {r[0]: r for r in brute(rows, arity)}
    assert len(got) == 150
    for r in got:
        assert tuple(r)[:5] == want[r["doc_id"]][:5] and r["folded"] == r["root"]


def test_leaves_tell_nulls_and_lengths_apart(spark):
    rows = [("-",), (None,), ("",), ("1:a",), ("a",)]
    df = spark.createDataFrame(rows, "v string").select(merkle.text_of(merkle.leaf([F.col("v")])).alias("d"))
    assert [r["d"] for r in df.collect()] == [leaf(r) for r in rows]


def test_arity_of_one_is_refused():
    with pytest.raises(ValueError):
        merkle.Levels(1)
