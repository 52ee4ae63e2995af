"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of `PASSAGE_WORDS` words, all of them).
Every passage is encoded (character-class bigrams, repetition and word-shape
figures, then a learned tanh layer); gated attention, learned from document
labels alone, weighs the passages; the weighted sum is scored.  So one bad
passage in a long document can decide, although no passage is labelled.

The model is fitted on the driver on a bounded sample of labelled documents
(`SAMPLE` in all, half of each label, by a hash of the id; a parameter).  Their
passages are used whole while they fit `4 * SAMPLE_BYTES` of features together (a
parameter); of the longest ones a hashed sample of passages is, if they do not.
Scoring reads every whole text, in tasks, document by document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmeter.llm.common import crc_fold, fresh
from gridmeter.session import drop_path, materialize

PASSAGE_WORDS = 48
CLASSES = 12
FEATURES = CLASSES * CLASSES + 6
HIDDEN, ATTENTION = 24, 16
SAMPLE = 3_000
SAMPLE_BYTES = 24_000_000

# Byte classes: space, newline, lower, upper, digit, sentence marks, quotes, brackets,
# pipes and slashes, other marks, beyond ASCII, control.
_CLASS = np.full(256, 11, np.uint8)
for _k, _chars in enumerate((b" \t", b"\n\r", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             b".,;:?", b"'\"`", b"()[]{}<>", b"|/\\_-=", b"!#$%&*+@^~")):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 10


def passages(text: str | None) -> np.ndarray:
    """Features of each passage of a text, at least one row (an empty text: zeros)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    n = -(-len(words) // PASSAGE_WORDS)
    raw = np.frombuffer(data, np.uint8)
    cls = _CLASS[raw].astype(np.int64)
    solid = (raw > 32) | (raw < 9) | ((raw > 13) & (raw < 32))  # the white space of bytes.split()
    starts = np.flatnonzero(solid & ~np.concatenate(([False], solid[:-1])))
    # The passage of each byte: that of the last word begun.
    cuts = starts[::PASSAGE_WORDS][:n]
    size = np.diff(np.concatenate((cuts, [len(raw)])))
    where = np.repeat(np.arange(len(cuts)), size)
    own = cls[cuts[0]:]
    pairs = np.bincount(where[:-1] * (CLASSES * CLASSES) + own[:-1] * CLASSES + own[1:],
                        minlength=len(cuts) * CLASSES * CLASSES).reshape(len(cuts), -1)
    out = np.zeros((len(cuts), FEATURES), np.float32)
    out[:, :-6] = np.sqrt(pairs / np.maximum(size, 1)[:, None])
    for i in range(len(cuts)):
        part = words[i * PASSAGE_WORDS:(i + 1) * PASSAGE_WORDS]
        if not part:
            continue
        kinds, m = len(set(part)), len(part)
        same = sum(a == b for a, b in zip(part, part[1:], strict=False))
        tails = len({w[-1] for w in part})
        out[i, -6:] = (kinds / m, same / m, min(size[i] / m / 10, 3), m / PASSAGE_WORDS, tails / m, 1)
    return out


def _forward(x: np.ndarray, w: dict) -> tuple:
    h = np.tanh((x - w["mean"]) @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    return h, t, s, (t * s) @ w["a"]


def score(x: np.ndarray, w: dict) -> float:
    """Probability of label 1 of one bag, in a running softmax over blocks of passages."""
    top, total, z = -np.inf, 0.0, np.zeros(HIDDEN)
    for i in range(0, len(x), 4_096):
        h, _, _, e = _forward(x[i:i + 4_096], w)
        m = max(top, float(e.max()))
        k = np.exp(e - m)
        z = z * np.exp(top - m) + k @ h
        total, top = total * np.exp(top - m) + float(k.sum()), m
    return float(1 / (1 + np.exp(-np.clip(z / total @ w["c"] + w["b"], -40, 40))))


def _wide(x: np.ndarray) -> np.ndarray:
    return x.astype(np.float32) if x.dtype == np.float16 else x


def _mean(bags: list[np.ndarray]) -> np.ndarray:
    """The mean of all rows, added in their order without laying the bags side by side."""
    total = _wide(bags[0]).sum(0)
    for bag in bags[1:]:
        total = np.add.reduce(np.concatenate((total[None], _wide(bag))))
    return np.true_divide(total, np.intp(sum(map(len, bags))), out=total, casting="unsafe")


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, seed: int = 7) -> dict:
    """Gated-attention weights by Adam on the log loss; `bags` in any order, labels 0 or 1.
    Bags of half-precision numbers stay so and are widened a batch at a time."""
    g = np.random.default_rng(seed)
    w = {"mean": _mean(bags) if bags else np.zeros(FEATURES), "E": g.normal(0, 0.3, (FEATURES, HIDDEN)),
         "e": np.zeros(HIDDEN), "V": g.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": g.normal(0, 0.3, (HIDDEN, ATTENTION)),
         "a": g.normal(0, 0.3, ATTENTION), "c": g.normal(0, 0.3, HIDDEN), "b": np.zeros(())}
    if not bags:
        return w
    keys = [k for k in w if k != "mean"]
    m1, m2, step = {k: np.zeros_like(w[k]) for k in keys}, {k: np.zeros_like(w[k]) for k in keys}, 0
    for epoch in range(epochs):
        order = g.permutation(len(bags))
        for at in range(0, len(order), 32):
            batch = order[at:at + 32]
            x = _wide(np.concatenate([bags[i] for i in batch]))
            n = np.array([len(bags[i]) for i in batch])
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            bag = np.repeat(np.arange(len(batch)), n)
            y = labels[batch]
            h, t, s, e = _forward(x, w)
            k = np.exp(e - np.maximum.reduceat(e, first)[bag])
            alpha = k / np.add.reduceat(k, first)[bag]
            z = np.add.reduceat(alpha[:, None] * h, first)
            p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -40, 40)))
            d = (p - y) / len(batch)
            dz = d[:, None] * w["c"]
            dh = alpha[:, None] * dz[bag]
            da = (dz[bag] * h).sum(1)
            de = alpha * (da - np.add.reduceat(alpha * da, first)[bag])
            dt, ds = de[:, None] * w["a"] * s * (1 - t * t), de[:, None] * w["a"] * t * s * (1 - s)
            dh += dt @ w["V"].T + ds @ w["U"].T
            dpre = dh * (1 - h * h)
            grad = {"E": (x - w["mean"]).T @ dpre, "e": dpre.sum(0), "V": h.T @ dt, "U": h.T @ ds,
                    "a": (t * s).T @ de, "c": z.T @ d, "b": d.sum()}
            step += 1
            rate = 0.01 * (0.1 if epoch >= epochs * 2 // 3 else 1)
            for key in keys:
                gk = grad[key] + 1e-5 * w[key]
                m1[key] = 0.9 * m1[key] + 0.1 * gk
                m2[key] = 0.999 * m2[key] + 0.001 * gk * gk
                w[key] = w[key] - rate * (m1[key] / (1 - 0.9 ** step)) / (np.sqrt(m2[key] / (1 - 0.999 ** step)) + 1e-8)
    return w


def passage_cap(n: np.ndarray, room: int) -> int:
    """The largest cap (1 at least) with which bags of `n` passages hold at most `room` in all."""
    n = np.sort(n)
    if n.sum() <= room:
        return int(n[-1]) if len(n) else 1
    # With the cap in place i, bags i and longer share what the shorter ones leave.
    left = (room - np.concatenate(([0], np.cumsum(n)[:-1]))) // np.arange(len(n), 0, -1)
    return max(1, int(left[np.argmax(left < n)]))


def thin(k: Column, n: Column, x: Column, cap: int) -> Column:
    """Bags of more than `cap` passages with so many of them, drawn by a hash of the id, in their order."""
    @F.arrow_udf("binary")
    def run(keys: pa.Array, sizes: pa.Array, bags: pa.Array) -> pa.Array:
        out = []
        for key, m, bag in zip(keys, sizes, bags, strict=True):
            m, bag = m.as_py(), bag.as_py()
            if m > cap:
                pick = np.random.default_rng(zlib.crc32(key.as_py().encode())).choice(m, cap, replace=False)
                bag = np.frombuffer(bag, "<f2").reshape(m, FEATURES)[np.sort(pick)].tobytes()
            out.append(bag)
        return pa.array(out, pa.binary())

    return run(k, n, x)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """Fit on at most `sample` labelled documents, half of each label, taken in the order
    of a hash of the id.  Four times `sample_bytes` bounds the features that reach the
    driver (two bytes a number): documents of more passages than a cap, the largest with
    which all fit (1 at least), are represented by so many, drawn by a hash in the tasks;
    no document is left out for its length.

    Labels other than 0 and 1, null ids and ids without a document are left out; a
    repeated id counts as often as it joins.  Without any labelled document the
    model is untrained and its scores mean nothing (but lie in 0 to 1).
    """
    ids = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    order = (F.xxhash64("k"), F.col("k"))
    halves = [ids.where(F.col("y") == y).orderBy(*order).limit(sample // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionAll(halves[1]))  # at most `sample` rows
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text")).join(chosen, "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [passages(t) for t in b["text"]]
            yield pd.DataFrame({"k": b["k"].astype(str), "y": b["y"], "n": [len(r) for r in rows],
                                "x": [r.astype("<f2").tobytes() for r in rows]})

    found, path = materialize(
        texts.mapInPandas(run, "k string, y int, n int, x binary")
        .select(F.monotonically_increasing_id().alias("row"), "*", F.xxhash64("x").alias("digest")), "quality-bags", with_path=True)
    try:
        # Sizes first; features then arrive in no order, at most as many as fit together.
        taken = (found.select("row", "k", "y", "n", "digest").orderBy(F.xxhash64("k"), "k", "digest", "row").limit(sample)
                 .select("row", "y", "n").collect())
        cap = passage_cap(np.array([r["n"] for r in taken], np.int64), 4 * sample_bytes // (2 * FEATURES))
        # One array for all, which is given back as a whole; many small ones leave the heap in pieces.
        ends = np.cumsum([min(r["n"], cap) for r in taken], dtype=np.int64)
        place = {r["row"]: i for i, r in enumerate(taken)}
        bags = np.split(np.empty((int(ends[-1]) if taken else 0, FEATURES), "<f2"), ends[:-1])
        features = thin(F.col("k"), F.col("n"), F.col("x"), cap) if any(r["n"] > cap for r in taken) else F.col("x")
        for row in found.where(F.col("row").isin([r["row"] for r in taken])).select("row", features.alias("x")).toLocalIterator():
            bags[place[row["row"]]][:] = np.frombuffer(row["x"], "<f2").reshape(-1, FEATURES)
    finally:
        drop_path(docs.sparkSession, path)
    return fit(bags if taken else [], np.array([r["y"] for r in taken], float))


def score_all(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the score of each whole text (double, 0 to 1); null and empty texts get
    the score of a bag with one empty passage.  A column named `out` is replaced."""
    docs = docs.drop(out) if out.lower() in [c.lower() for c in docs.columns] else docs

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # Python strings of one text at a time.
            yield pa.array([score(passages(t.as_py()), model) for t in texts], pa.float64())

    return docs.withColumn(out, run(F.col(text_col)))


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for the fold that training never sees (null ids: false)."""
    return F.coalesce(crc_fold(id_col, folds) == 0, F.lit(False))


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` whose score is at least `threshold`, with the columns of `docs`."""
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col)
    name = fresh(docs, "score")
    return score_all(docs, model, text_col, name).where(F.col(name) >= threshold).drop(name)
