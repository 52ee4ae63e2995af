"""Exact dedup and SimHash near-dedup."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from gridmeter.llm import exact_dedup, queries, simhash
from tests.llm.conftest import SF, odd_rows


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_odd_rows(odd):
    got = exact_dedup.dedup(odd).collect()
    rows = odd_rows()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for r in rows:
        groups[hashlib.sha256(norm(r[1]).encode()).hexdigest()].append(r[0])
    for r in got:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None)
    for digest in groups:
        assert sum(r["kept"] for r in got if r["text_sha256"] == digest) == 1


def test_exact_dedup_keeps_rows_whole(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    texts = [norm(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in odd_rows()})


def test_index_persists_over_batches(spark, scratch):
    path = f"{scratch}/index"
    first = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a  b"), (2, "d"), (3, "d")], "doc_id long, text string")
    exact_dedup.DigestIndex(spark, "digest_a", 4, path).add(first)
    spark.sql("DROP TABLE digest_a")  # an external table: the files stay
    index = exact_dedup.DigestIndex(spark, "digest_b", 4, path)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(second).collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)}
    assert index.table().count() == 3


def test_exact_dedup_empty(empty):
    assert exact_dedup.dedup(empty).count() == 0
    assert exact_dedup.keep_first(empty).count() == 0


def brute_prints(rows, width):
    prints = {}
    for n, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[n] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if grams else 0
    return prints


def brute_groups(prints, bits):
    names = list(prints)
    values = np.array([prints[n] for n in names], np.uint64)
    least = dict.fromkeys(names)
    for n in names:
        if least[n] is not None:
            continue
        todo, seen = [n], {n}
        while todo:
            near = np.bitwise_count(values ^ np.uint64(prints[todo.pop()])) <= bits
            for i in np.flatnonzero(near):
                if names[i] not in seen:
                    seen.add(names[i])
                    todo.append(names[i])
        for m in seen:
            least[m] = min(seen)
    return least


def test_simhash_query_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = brute_prints(rows, 4)
    groups = brute_groups(prints, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op10_simhash(spark, SF).collect()}
    assert got == {n: (f"{prints[n]:016x}", groups[n]) for n, _ in rows}


def test_links_are_complete_across_tiles(spark, monkeypatch):
    g = np.random.default_rng(5)
    centres = g.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = set()
    for i in range(600):  # groups of near fingerprints, far larger than a tile
        flips = g.choice(64, g.integers(0, 4), replace=False)
        values.add(int(centres[i % 6] ^ np.uint64(sum(1 << int(f) for f in flips))))
    values |= {int(x) for x in g.integers(0, 1 << 63, 100, dtype=np.uint64)}
    monkeypatch.setattr(simhash, "TILE", 16)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in values], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, 4)).collect()}
    want = brute_groups({(x - (1 << 64) if x >> 63 else x): x for x in values}, 4)
    assert {n: roots.get(n, n) for n in want} == want


def test_simhash_odd_rows(odd):
    got = simhash.near_groups(odd).collect()
    assert len(got) == len(odd_rows())
    blank = {r["doc_id"]: r["fp"] for r in got if r["doc_id"] in (4, 5, 6, 7)}
    assert set(blank.values()) == {0}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    # One row a group: 1 (with 2 and 3), 4 (all blank texts), the German one (null id), and the rest.
    assert ids == [1, 4, 8, 9, 10, 11, None]


def test_simhash_empty(empty):
    assert simhash.near_groups(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_simhash_keeps_same_id_in_other_groups(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve")], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 2
    assert docs.select(F.col("doc_id")).count() == 2
