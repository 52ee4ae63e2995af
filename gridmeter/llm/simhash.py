"""SimHash near-dedup by pigeonhole blocks.

1. Each text gets a 64-bit fingerprint of its word shingles (XXH64).  Texts
   are read once; from then on only fingerprints and ids move.
2. Equal fingerprints are one node with the smallest id (partial aggregation:
   a group of exact copies shrinks before the shuffle).
3. A fingerprint is cut into `max_bits + KEPT` blocks.  Two fingerprints that
   differ in at most `max_bits` bits agree in at least `KEPT` whole blocks, so
   they share one of the keys made of `KEPT` blocks (35 keys of 27 bits for 4
   bits).  Random fingerprints rarely share so long a key, so the candidate
   lists stay short as the table grows.
4. Nodes are joined on keys and verified by the Hamming distance.  Each key's
   nodes lie side by side in sorted partitions; a key with more than `TILE`
   nodes is cut into tiles, and each pair of tiles is its own unit of work, so
   no list is bounded by a group's size and no pair is left out.  What leaves a
   unit is not every pair but a spanning forest (node to root), at most one
   row per node.
5. Components by min-label rounds over the forest edges, each round written
   to the shared folder; no edges or components reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmeter.llm.common import fresh, text_or_empty
from gridmeter.session import materialize

KEPT = 3
TILE = 4_096
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = bytes(32 if 9 <= c <= 13 else c for c in range(256))


def fingerprint(text: str | None, width: int = 4) -> int:
    """The 64-bit SimHash (unsigned) of one text: A-Z lower-cased, words split at
    space and tab to carriage return, shingles of `width` words with repeats
    (the whole sequence if there are fewer; 0 if there are none)."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    w = min(width, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[a:b], 42) for a, b in zip(starts[:len(words) - w + 1].tolist(), ends[w - 1:].tolist(), strict=True)),
                         np.uint64, len(words) - w + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i:i + 65_536].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, h, fp long) for every row; null texts count as empty.  `h` is a hash of the
    whole text, to tell rows with the same id apart."""
    schema = f"id {dict(docs.dtypes)[id_col]}, h bigint, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):  # Python strings of a few texts at a time
                part = b.slice(at, 256)
                fps = np.array([fingerprint(t, width) for t in part.column(2).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps)], names=["id", "h", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("h"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def block_masks(max_bits: int) -> list[int]:
    """The masks of all keys: `KEPT` of `max_bits + KEPT` blocks of 64 bits."""
    n = max_bits + KEPT
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    assert len(list(combinations(blocks, KEPT))) == comb(n, KEPT)
    return [sum(c) for c in combinations(blocks, KEPT)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(nodes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within `nodes` (at most two tiles) by breadth-first
    search: edges (node, root)."""
    fps = nodes.view(np.uint64)
    left, edges = np.ones(len(fps), bool), []
    for i in range(len(fps)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            near = rest[np.bitwise_count(fps[rest] ^ fps[todo.pop()]) <= max_bits]
            left[near] = False
            todo += near.tolist()
            edges += [(int(nodes[j]), int(nodes[i])) for j in near]
    return edges


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b) over the column `fp` of `nodes` (distinct): a spanning forest, within
    each key, of all pairs that differ in at most `max_bits` bits."""
    spark = nodes.sparkSession
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(max_bits)])
    keyed = nodes.select("fp", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("k", "key"))
    # Keys with two nodes or more, and how many tiles they need.
    shared = (keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("k", "key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")))
    found = keyed.join(shared.hint("shuffle_hash"), ["k", "key"])
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    units = (found.withColumn("t", tile)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("k", "key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "fp")
             # A tile alone is compared with itself in each of its pairs; (i, i) is needed only if it is the one tile.
             .where("i != j or (i = 0 and j = 0)"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parts, "k", "key", "i", "j").sortWithinPartitions("k", "key", "i", "j", "fp")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, held_key = [], None

        def out(fps: list[np.ndarray]) -> list[tuple[int, int]]:
            return _forest(np.concatenate(fps), max_bits)

        for b in batches:
            edges: list[tuple[int, int]] = []
            cols = [b[c].to_numpy() for c in ("k", "key", "i", "j")]
            fp = b["fp"].to_numpy()
            if not len(fp):
                continue
            cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            for part, at in zip(np.split(fp, cut), [0, *cut.tolist()], strict=True):
                key = tuple(int(c[at]) for c in cols)
                if key != held_key and held:
                    edges += out(held)
                    held = []
                held_key = key
                held.append(part)
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
        if held:
            yield pd.DataFrame(out(held), columns=["a", "b"], dtype="int64")

    return dealt.mapInPandas(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): the smallest node reachable.

    Alternating large-star and small-star rounds: each joins every node to the
    smallest node among itself and its neighbours, which halves distances; edges
    stay at most as many as they were.  Each round is one pair of partial
    aggregations and shuffles, written to the shared folder; it ends when a
    round changes nothing.
    """
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    while True:
        # Large star: every neighbour that is larger than the node joins the smallest one around the node.
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: a node and its smaller neighbours join the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a != b").distinct())
        then = materialize(small, "links")
        same = then.count() == now.count() and then.join(now, ["a", "b"], "left_anti").isEmpty()
        now = then
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row per row of `docs`: id, `h` (hash of the text), `fp` (long), `root` (a
    fingerprint that names the group) and `component_id` (smallest id reachable by
    links of at most `max_bits` bits, its own included).

    Null texts, empty texts and texts of white space have fingerprint 0 and are
    linked like any other.  Equal and repeated rows share a component.  Rows
    with a null id take part in links, but a null id is never a component's
    name unless the component has no other.  An empty table gives an empty
    result.  Other columns are not read.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes.select("fp"), max_bits))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(labelled.join(names, "root").select("fp", "root", "component_id"), "components")
    # One row per fingerprint against the rows: both sides shuffled, so AQE can split a hot fingerprint.
    return (prints.join(named.hint("merge"), "fp")
            .select(F.col("id").alias(id_col), "h", "fp", "root", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
             max_bits: int = 4) -> DataFrame:
    """One row of each group, with the columns of `docs`: the one with the smallest id
    (null ids last; of rows with the same id, the smallest text hash; of rows that
    repeat id and text, one)."""
    key, null, text = fresh(docs, "key"), fresh(docs, "null"), fresh(docs, "text")
    groups = near_groups(docs, id_col, text_col, width, max_bits)
    first = F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), "h"))
    # Plain key columns, so that the join's partitioning also serves the last step.
    stay = groups.groupBy("root").agg(first.alias("f")).select(
        F.coalesce(F.col("f.id").cast("string"), F.lit("")).alias(key), F.col("f.n").alias(null), F.col("f.h").alias(text))
    marked = docs.withColumns({key: F.coalesce(F.col(id_col).cast("string"), F.lit("")), null: F.col(id_col).isNull(),
                               text: F.xxhash64(text_or_empty(text_col))})
    keys = [key, null, text]
    return marked.join(stay, keys, "left_semi").dropDuplicates(keys).drop(*keys)
