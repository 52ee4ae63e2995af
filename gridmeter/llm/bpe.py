"""Byte-level BPE: ranked merges, one step of all words of a block at a time.

Encoding, in one narrow stage without a shuffle.  Each task cuts its texts into blocks of
about `BLOCK_BYTES` (whole texts) and each text into words by the tokenizer's pattern.
The distinct words of a block that are no token themselves are laid into one array of
byte tokens with the ranks of neighbouring pairs beside it; every step finds each word's
smallest rank, merges its leftmost pair and looks up the two new pairs, until no word
has a pair left.  Then each text's words are replaced by their tokens.

Decoding concatenates the binary pieces of the tokens.

The rank map gives the rank of a pair of tokens as one array access: the rows
of the sparse pair table are laid into one array, shifted so that no two entries
meet, and an entry holds its left token to tell a hit from another row's entry.
It is bounded by the vocabulary (at most 2^20 tokens).
"""

from __future__ import annotations

import base64
import gc
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.llm import chunks as _chunks
from gridmeter.llm.common import fresh

BLOCK_BYTES = 12 << 20
_EMPTY = 1 << 62


class Ranks(NamedTuple):
    """A vocabulary with its pair table; see the module."""
    ids: dict[bytes, int]
    bits: int            # tokens are stored with bit `bits` set, ranks are below it
    pair: np.ndarray     # left token << shift | rank, at place[left] + right
    place: np.ndarray

    @property
    def shift(self) -> int:
        return self.bits + 4

    @property
    def flag(self) -> int:
        return 1 << self.bits

    @property
    def edge(self) -> int:
        """The mark at both ends of a word; it pairs with nothing."""
        return 2 << self.bits


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 piece and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pair_table(ids: dict[bytes, int]) -> Ranks:
    """The rank of every pair of tokens whose concatenation is a token."""
    lacking = [i for i in range(256) if bytes([i]) not in ids]
    if lacking:
        raise ValueError(f"the vocabulary lacks the bytes {lacking[:5]}")
    bits = max(ids.values()).bit_length()
    if bits > 20:
        raise ValueError("the vocabulary has more than 2^20 tokens")
    flag, edge, shift = 1 << bits, 2 << bits, bits + 4
    rows: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for piece, rank in ids.items():
        for i in range(1, len(piece)):
            a, b = ids.get(piece[:i]), ids.get(piece[i:])
            if a is not None and b is not None:
                rows[a | flag].append((b | flag, rank))
    total = sum(map(len, rows.values()))
    used = np.zeros(16 * total + 4 * edge, bool)
    pair, place = np.full(len(used), _EMPTY, np.int64), np.zeros(edge + 1, np.int64)
    low, last = 0, {}
    # First fit, longest rows first; rows of one length go on where the last one was placed.
    for left in sorted(rows, key=lambda k: -len(rows[k])):
        right = np.array([b for b, _ in rows[left]])
        gaps = right - right.min()
        at, step = max(low, last.get(len(right), 0)), 256 if len(right) <= 16 else max(64, 200_000 // len(right))
        while True:
            free = np.flatnonzero(~used[at:at + step]) + at
            fits = ~used[free[:, None] + gaps].any(axis=1) if len(free) else np.zeros(0, bool)
            if fits.any():
                break
            at += step
        start = int(free[fits.argmax()])
        used[start + gaps] = True
        pair[start + gaps] = [(left << shift) | r for _, r in rows[left]]
        place[left] = start - int(right.min())
        last[len(right)] = start
        while used[low]:
            low += 1
    size = max(edge + 1, int(np.flatnonzero(used).max(initial=0)) + 1)
    return Ranks(ids, bits, pair[:size], place)


def _constant(spark: SparkSession, value: dict, kind: str) -> Column:
    """A constant that a plan evaluates once: a scalar subquery over one row."""
    return spark.createDataFrame([(json.dumps(value),)], "j string").select(F.from_json("j", kind).alias("v")).scalar()


def _pair_ranks(ranks: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The rank of each pair of tokens; at least `flag` where it is none."""
    at = ranks.place[left] + right
    inside = (at >= 0) & (at < len(ranks.pair))
    entry = ranks.pair[np.where(inside, at, 0)]
    hit = inside & (entry >> ranks.shift == left)
    return np.where(hit, entry & ((1 << ranks.shift) - 1), ranks.flag)


def merge(words: list[bytes], ranks: Ranks, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each word, the ids of all words in order): in every word, of one byte
    at least, the leftmost pair of the smallest rank is merged until none is left."""
    sizes = np.array([len(w) for w in words], np.int64)
    token = byte[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    rank = np.full(len(token), ranks.flag, np.int64)
    same = np.flatnonzero(word[:-1] == word[1:])
    rank[same] = _pair_ranks(ranks, token[same], token[same + 1])
    done = [(word[:0], token[:0])]
    while len(token):
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        best = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), starts)
        live = best >> 32 < ranks.flag
        keep = np.repeat(live, np.diff(np.append(starts, len(word))))
        done.append((word[~keep], token[~keep]))
        at = best[live] & 0xFFFFFFFF
        token[at] = best[live] >> 32 | ranks.flag
        keep[at + 1] = False  # what was there is part of the merged token
        now = np.cumsum(keep)[at] - 1
        token, word, rank = token[keep], word[keep], rank[keep]
        for first in (now - 1, now):  # the pairs on either side of each merged token
            first = first[(first >= 0) & (first + 1 < len(word))]
            first = first[word[first] == word[first + 1]]
            rank[first] = _pair_ranks(ranks, token[first], token[first + 1])
        end = (now + 1 >= len(word)) | (word[np.minimum(now + 1, len(word) - 1)] != word[now])
        rank[now[end]] = ranks.flag
    word, token = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return np.bincount(word, minlength=len(words)), (token[order] & (ranks.flag - 1)).astype(np.int32)


class _Words(dict):
    """The distinct words of one block (word -> number), and its texts as lists of them."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class _Chunks(dict):
    """The words of each distinct chunk of one block, found when a chunk (by its key) is first met."""

    def __init__(self, pattern: str):
        super().__init__()
        self.find, self.words = regex.compile(pattern).findall, _Words()

    def __missing__(self, key: str) -> tuple[int, ...]:
        self[key] = own = tuple(map(self.words.__getitem__, self.find(_chunks.chunk(key))))
        return own

    def numbers(self, text: str) -> bytes:
        """The words of a whole text, as 32-bit integers."""
        cut = map(self.__getitem__, _chunks.keys(text))
        return np.fromiter(chain.from_iterable(cut), np.int32).tobytes()


def _word_ids(words: list[str], ranks: Ranks, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each word's ids begin, how many they are, the ids of all)."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    known = np.array([ranks.ids.get(r, -1) for r in raw], np.int32)
    rest = np.flatnonzero(known < 0)
    sizes, flat, used = np.ones(len(words), np.int64), [known], len(words)
    starts = np.arange(len(words))
    for i in range(0, len(rest), 16_384):
        own = rest[i:i + 16_384]
        sizes[own], ids = merge([raw[k] for k in own], ranks, byte)
        starts[own] = used + np.cumsum(sizes[own]) - sizes[own]
        flat.append(ids)
        used += len(ids)
    return starts, sizes, np.concatenate(flat)


def _gather(starts: np.ndarray, lens: np.ndarray, values: np.ndarray, idx: np.ndarray) -> np.ndarray:
    n = lens[idx]
    if not len(n):
        return values[:0]
    out = np.cumsum(n)
    return values[np.repeat(starts[idx] - (out - n), n) + np.arange(out[-1])]


def encode(docs: DataFrame, ranks: Ranks, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           out: str = "ids", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, `out` array<int>) for every row of `docs`, as the rank file's library encodes
    the whole text without special tokens.

    Null and empty texts have no tokens.  Null and repeated ids are passed on.
    Other columns are not read.  A word takes time with the square of its
    length; the pattern keeps words of one kind of character apart.
    """
    arrow = docs.select(F.col(id_col).alias("id")).limit(0).toArrow().schema.field("id").type
    kind = dict(docs.dtypes)[id_col]
    byte = np.array([ranks.ids[bytes([i])] | ranks.flag for i in range(256)], np.int64)
    schema = pa.schema([("id", arrow), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes cycles, and a block has many objects to look through
        block, texts, size = _Chunks(pattern), [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            table = _word_ids(list(block.words), ranks, byte)
            for i in range(0, len(texts), 256):
                part = texts[i:i + 256]
                got = [_gather(*table, np.frombuffer(s, np.int32)) for _, s in part]
                offsets = np.cumsum([0, *map(len, got)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in part], arrow), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got)))],
                    schema=schema)
        for b in batches:
            for at in range(0, len(b), 256):  # Python strings of a few texts at a time
                part = b.slice(at, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    texts.append((key, block.numbers(text or "")))
                    size += len(text or "")
                    if size >= block_bytes:
                        yield from rows()
                        block, texts, size = _Chunks(pattern), [], 0
        if texts:
            yield from rows()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")
    return rows.select(F.col("id").alias(id_col), F.col("ids").alias(out))


def decode(encoded: DataFrame, ids: dict[bytes, int], ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of each row's tokens (binary); null ids: null.
    An unknown token makes the row's bytes null.  A column named `out` is replaced."""
    pieces = [""] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        pieces[i] = piece.hex()
    table = fresh(encoded, "pieces")
    known = _constant(encoded.sparkSession, {"v": [p or None for p in pieces]}, "struct<v:array<string>>")
    keep = [c for c in encoded.columns if c.lower() != out.lower()]
    # A missing piece becomes a mark that is no hexadecimal digit, so that unhex gives null.
    joined = (f"aggregate(array({table}.v), cast(null as binary), (z, v) -> "
              f"unhex(array_join(transform(`{ids_col}`, i -> get(v, i)), '', '?')))")
    return encoded.select("*", known.alias(table)).select(*keep, F.expr(joined).alias(out))
