"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by fast Hadamard pseudo-rotations (sign flips and a Hadamard
transform, three times) and assigned to the nearest signed axis; a table's key is the
pair of axes of two rotations.  A query probes, in each of `TABLES` tables, the
`PROBES` keys whose axes lie nearest to it (up to 64 dimensions; beyond, more of both,
see `effort`); what it finds is reranked by the exact Euclidean distance of the
original vectors.  A query that finds fewer than `k` rows probes all keys of the block,
and so do all queries of a block of no more rows than a table's probes.

Every row is indexed.  Rows are dealt by a hash of the id into blocks of about
`BLOCK_ROWS`, queries into chunks of about `CHUNK_ROWS`; each (block, chunk) is one
bounded unit of work that hashes the block, probes it and returns the `k` nearest
found for each query.  So a bucket that holds a third of all rows (one vector very
often) is spread over all blocks, candidate pairs never become rows, and recall does
not fall as the table grows: a neighbour is found or not within its own block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLES = 32
PROBES = 200
AXES = 32  # axes of each rotation that a query considers
SIDES = 128  # signed axes for which these numbers are meant (64 dimensions)
BLOCK_ROWS = 8_192
CHUNK_ROWS = 2_048
SEED = 17


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long), scaled to keep
    lengths: one small transform along each group of up to four of the index's bits."""
    n, d = x.shape
    done = 1
    while done < d:
        r = min(16, d // done)
        h = np.ones((1, 1), x.dtype)
        while len(h) < r:
            h = np.block([[h, h], [h, -h]])
        x = np.matmul(h, x.reshape(n, d // (done * r), r, done)).reshape(n, d)
        done *= r
    return x * x.dtype.type(1 / np.sqrt(d))


def rotations(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-rotation of the rows of `x`, and their negatives beside it: one value for each signed axis."""
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0], x.dtype), (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return np.concatenate((x, -x), axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (safely for huge and tiny ones) and padded to a power of two."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = np.zeros((len(x), 1 << max(0, (x.shape[1] - 1).bit_length())), np.float32)
    out[:, :x.shape[1]] = x
    return out


def effort(sides: int) -> tuple[int, int, int]:
    """Tables, probes and axes for so many signed axes: the same share of the keys is
    probed in any dimension from 64 on, in more tables, as unrelated rows lie more alike."""
    scale = max(1.0, sides / SIDES)
    return round(TABLES * scale ** 0.5), round(PROBES * scale ** 2), min(round(AXES * scale), sides)


def search_block(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int,
                 tables: int | None = None, probes: int | None = None) -> list[tuple[int, int, float]]:
    """(query id, id, distance) of the `k` nearest found of each query among the rows of `x`:
    `k` of them, or all but the query itself if there are fewer."""
    out = []
    hits = _hits(x, q, tables, probes)
    other = q_ids[:, None] != ids
    hits &= other
    short = hits.sum(axis=1) < np.minimum(k, other.sum(axis=1))
    hits[short] = other[short]
    # Products give all distances roughly; those that may be among the k nearest are
    # computed exactly from the original vectors.  Squares of huge or tiny components
    # would not be numbers, so such a block is scaled for the products.
    largest = max(np.abs(x).max(), np.abs(q).max())
    scale = 1.0 if 1e-100 < largest < 1e100 else 1 / largest if largest < 1e300 else 1e-300
    sx, sq = x * scale, q * scale
    squares, q_squares = (sx * sx).sum(axis=1), (sq * sq).sum(axis=1)
    rough = squares + q_squares[:, None] - 2 * (sq @ sx.T)
    slack = 1e-9 * (squares.max() + q_squares)
    rough[~hits] = np.inf
    cut = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(q), np.inf)
    for i in range(len(q)):
        found = np.flatnonzero((rough[i] <= cut[i] + slack[i]) & np.isfinite(rough[i]))
        distance = _distances(x[found], q[i])
        first = np.lexsort((ids[found], distance))[:k]
        out += [(int(q_ids[i]), int(ids[found[j]]), float(distance[j])) for j in first]
    return out


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of `x` from `q`; where squares over- or underflow, from
    differences scaled by the largest."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = x - q
        out = np.sqrt((d * d).sum(axis=1))
        odd = np.flatnonzero(~((out > 1e-100) & (out < 1e100)))
        most = np.abs(d[odd]).max(axis=1, keepdims=True)
        fine = (most > 0) & np.isfinite(most)
        part = np.sqrt((np.divide(d[odd], most, where=fine, out=np.zeros_like(d[odd])) ** 2).sum(axis=1))
        out[odd] = np.where(fine[:, 0], most[:, 0] * part, most[:, 0])
    return out


def _hits(x: np.ndarray, q: np.ndarray, tables: int | None, probes: int | None) -> np.ndarray:
    """Which rows of `x` (columns) each query's probes find."""
    sides = 2 << max(0, (x.shape[1] - 1).bit_length())
    derived_tables, derived_probes, axes = effort(sides)
    tables = derived_tables if tables is None else tables
    probes = derived_probes if probes is None else probes
    if probes >= len(x):
        return np.ones((len(q), len(x)), bool)
    ux, uq = _unit(x), _unit(q)
    hits = np.zeros((len(q), len(x)), bool)
    step = max(1, 512 * AXES * AXES // (axes * axes))
    for t in range(tables):
        own = [rotations(ux, SEED + 2 * t + i).argmax(axis=1) for i in (0, 1)]
        keys = own[0] * sides + own[1]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        near = [rotations(uq, SEED + 2 * t + i) for i in (0, 1)]
        for at in range(0, len(q), step):
            part = [n[at:at + step] for n in near]
            top = [np.argpartition(-n, axes - 1, axis=1)[:, :axes] for n in part]
            value = [np.take_along_axis(n, o, axis=1) for n, o in zip(part, top, strict=True)]
            both = (value[0][:, :, None] + value[1][:, None, :]).reshape(len(part[0]), -1)
            best = np.argpartition(-both, min(probes, both.shape[1]) - 1, axis=1)[:, :probes]
            probe = np.take_along_axis(top[0], best // axes, axis=1) * sides + np.take_along_axis(top[1], best % axes, axis=1)
            lo, hi = np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right")
            n = (hi - lo).ravel()
            ends = np.cumsum(n)
            rows = np.repeat(np.arange(at, at + len(part[0])), (hi - lo).sum(axis=1))
            hits[rows, order[np.repeat(lo.ravel() - (ends - n), n) + np.arange(len(rows))]] = True
    return hits


def usable(vector: str) -> Column:
    """Not null, not empty, not all zero, every component there and finite."""
    bad = F.exists(F.col(vector), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(F.col(vector), lambda v: v != 0), F.lit(False))


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
           tables: int | None = None, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each row for which `queries`
    (a condition on `vectors`) holds, among all other rows, nearest first, ties to the smaller id.

    Vectors that are null, empty, all zero, or hold a null or non-finite component take
    no part, nor do rows with a null id.  Of rows with the same id the smallest vector
    counts.  Vectors of different lengths are never neighbours.  Only fewer other rows of
    a length than `k` give shorter lists, which then hold them all; empty tables give an
    empty result.  Other columns are not read.  `tables` and `probes` follow from the
    dimension unless given.
    """
    rows = (vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("q"))
            .groupBy("id").agg(F.min(F.struct("v", "q")).alias("r")).select("id", "r.v", "r.q", F.size("r.v").alias("dim")))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    blocks, chunks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_queries // CHUNK_ROWS))
    place = F.xxhash64(F.lit(SEED), "id")
    base = (rows.withColumn("block", F.pmod(place, F.lit(blocks)))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint")))))
    asked = (rows.where("q").withColumn("chunk", F.pmod(F.shiftrightunsigned(place, 20), F.lit(chunks)))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))))

    def unit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, x = left["id"].to_numpy(), np.array(left["v"].tolist(), np.float64)
            q_ids, q = right["id"].to_numpy(), np.array(right["v"].tolist(), np.float64)
            for at in range(0, len(q), 512):
                found += search_block(ids, x, q_ids[at:at + 512], q[at:at + 512], k, tables, probes)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["dim", "block", "chunk"]
    found = (base.select(*keys, "id", "v").groupBy(*keys).cogroup(asked.select(*keys, "id", "v").groupBy(*keys))
             .applyInPandas(unit, "query_id bigint, vec_id bigint, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
