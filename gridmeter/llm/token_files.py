"""Token ids as bit-packed files.

Each id takes the least bits that hold the vocabulary.  The ids of all documents,
in ascending order of document id, form one stream, cut into shards (ranges of
document ids) and blocks of whole documents (`BLOCK` ids or a little more).  The
files are Parquet, so that any store Spark writes to will do and a lost executor's
output is committed once or not at all:

  <path>/blocks   shard, block, first (place of its first id in the shard), n (ids),
                  bits, doc_ids, ends (of each document, in the block), packed (binary)
  <path>/starts   shard, base (ids of all shards before it)

A block unpacks with numpy alone, whole or from any id on.  The id at a place of
the stream is in the block of the shard whose range holds the place.

Texts are tokenised where they are read; only packed ids are shuffled, once, to
their shard.  Shard borders come from the document ids alone.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmeter.llm import chunks as _chunks

BLOCK = 65_536
SHARD_DOCS = 8_192
MAX_SHARDS = 10_000
CACHE = 500_000


def bits_of(vocabulary: int) -> int:
    """The least bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as `bits` bits each, lowest bit first; raises on an id that does not fit."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} does not fit into {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int, at: int = 0) -> np.ndarray:
    """`n` ids from the id number `at` on."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n, at * bits // 8).astype(np.uint32)
    raw = np.frombuffer(data, np.uint8)[at * bits // 8:((at + n) * bits + 7) // 8]
    flat = np.unpackbits(raw, bitorder="little")[at * bits % 8:][:n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


class _Numbers(dict):
    """Chunks (by their keys) with their numbers, in order; one that is asked for gets the next."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class _Grown:
    """An array that grows at its end, in amortised steps."""

    def __init__(self, kind):
        self.array, self.n = np.zeros(1_024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.array):
            wider = np.zeros(max(2 * len(self.array), self.n + len(more)), self.array.dtype)
            wider[:self.n] = self.array[:self.n]
            self.array = wider
        self.array[self.n:self.n + len(more)] = more
        self.n += len(more)


class Tokens:
    """The tokenizers library with a bounded memory of chunks it has encoded.

    With `byte_level`, texts are cut where a byte-level pattern always cuts and each
    distinct chunk of a batch is encoded once; the first `CACHE` chunks are also
    remembered for later batches.  A text that holds an added token's string goes
    to the library whole.
    """

    def __init__(self, path: str, byte_level: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.byte_level = byte_level
        self.seen: dict[str, int] = {}  # chunk -> its number of ids (counts)
        self.numbers = _Numbers()       # a chunk's key -> its number (ids)
        self.starts, self.sizes = _Grown(np.int64), _Grown(np.int64)  # of each number's ids in `flat`
        self.flat = _Grown(np.uint32)
        vocabulary = self.library.get_vocab(True)
        # Tokens that begin with a space, which byte-level vocabularies write as this letter.
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = [i for i, t in enumerate(texts) if not self.byte_level or any(a in t for a in self.added)]
        out: list = [None] * len(texts)
        for i, e in zip(whole, self.library.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        known = len(self.numbers)
        cut = {}
        for i, t in enumerate(texts):
            if out[i] is None:
                keys = _chunks.keys(t)
                cut[i] = np.fromiter(map(self.numbers.__getitem__, keys), np.int32, len(keys))
        new = list(map(_chunks.chunk, islice(reversed(self.numbers), len(self.numbers) - known)))[::-1]
        keep = max(0, CACHE - known)
        # Those that stay in memory first, so that the others can be cut off at the end.
        self._remember(new[:keep])
        n, used = self.starts.n, self.flat.n
        self._remember(new[keep:])
        for i, numbers in cut.items():
            lens = self.sizes.array[numbers]
            stop = np.cumsum(lens)
            total = int(stop[-1]) if len(stop) else 0
            out[i] = self.flat.array[np.repeat(self.starts.array[numbers] - (stop - lens), lens) + np.arange(total)]
        for _ in range(len(self.numbers) - n):
            self.numbers.popitem()
        self.starts.n, self.sizes.n, self.flat.n = n, n, used
        return out

    def _remember(self, new: list[str]) -> None:
        starts, sizes, ids = self._encode(new)
        self.starts.add(self.flat.n + starts)
        self.sizes.add(sizes)
        self.flat.add(ids)

    def counts(self, texts: list[str]) -> list[int]:
        """The number of ids of each text, by the same way without the ids."""
        whole = [i for i, t in enumerate(texts) if not self.byte_level or any(a in t for a in self.added)]
        out: list = [None] * len(texts)
        for i, e in zip(whole, self.library.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True):
            out[i] = len(e)
        cut = {i: _chunks.chunks(t) for i, t in enumerate(texts) if out[i] is None}
        new = list(set(chain.from_iterable(cut.values())) - self.seen.keys())
        _, sizes, _ = self._encode(new)
        self.seen.update(zip(new, sizes.tolist(), strict=True))
        for i, cs in cut.items():
            out[i] = sum(map(self.seen.__getitem__, cs))
        for c in new[max(0, CACHE - (len(self.seen) - len(new))):]:
            del self.seen[c]
        return out

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each chunk's ids begin, how many they are, the ids of all)."""
        # Chunks whose only space is their first character, and that end with something else than
        # white space, may stand side by side in one text: no token crosses from one into the
        # next, so the tokens that begin with a space are their first ones.
        side = [i for i, c in enumerate(new) if c.rfind(" ") == 0 and not c[-1].isspace()]
        joined = set(side)
        alone = [i for i in range(len(new)) if i not in joined]
        starts, sizes = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        flat, used = [], 0
        for at in range(0, len(side), 65_536):
            own = side[at:at + 65_536]
            lists = [[new[i] for i in own[j:j + 256]] for j in range(0, len(own), 256)]
            found = self.library.encode_batch_fast(["".join(x) for x in lists], add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
            first = np.flatnonzero(self.spaced[ids])
            # Their count in every list must be its chunks'; another vocabulary's chunks go one by one.
            ends = np.searchsorted(first, np.cumsum([len(e) for e in found]))
            if not np.array_equal(ends, np.cumsum([len(x) for x in lists])):
                alone += own
                continue
            starts[own] = used + first
            sizes[own] = np.diff(np.append(first, len(ids)))
            flat.append(ids)
            used += len(ids)
        for at in range(0, len(alone), 4_096):
            own = alone[at:at + 4_096]
            found = self.library.encode_batch_fast([new[i] for i in own], add_special_tokens=False)
            lens = np.array([len(e) for e in found], np.int64)
            sizes[own] = lens
            starts[own] = used + np.cumsum(lens) - lens
            flat.append(np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32))
            used += len(flat[-1])
        return starts, sizes, np.concatenate([*flat, np.zeros(0, np.uint32)])


def encode(docs: DataFrame, tokenizer: str, bits: int, end_id: int | None, id_col: str = "doc_id",
           text_col: str = "text", byte_level: bool = True) -> DataFrame:
    """(id, row, n long, packed binary) for every row; null texts count as empty."""
    kind = dict(docs.dtypes)[id_col]
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gc.disable()  # nothing here makes cycles, and the memory has many objects to look through
        tokens = Tokens(tokenizer, byte_level)
        for b in batches:
            for at in range(0, len(b), 2_048):
                part = b.iloc[at:at + 2_048]
                ids = [np.concatenate((x, end)) for x in tokens.ids([t or "" for t in part["text"]])]
                yield pd.DataFrame({"id": part["id"].array, "row": part["row"].array, "n": [len(x) for x in ids],
                                    "packed": [pack(x, bits) for x in ids]})

    return docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, row bigint, n bigint, packed binary")


def write(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int | None = 0, id_col: str = "doc_id",
          text_col: str = "text", byte_level: bool = True, shard_docs: int = SHARD_DOCS) -> None:
    """Encode every whole text of `docs`, append `end_id`, and write the files under `path`.

    Documents stand in ascending order of their (numeric) ids, null ids first, rows
    with one id in the order in which they are read.  Null and empty texts have only
    the end id.  An id that `vocabulary` has no bits for raises.  An empty table gives
    empty files.  Other columns are not read.
    """
    spark, bits, kind = docs.sparkSession, bits_of(vocabulary), dict(docs.dtypes)[id_col]
    shards = max(1, min(MAX_SHARDS, -(-docs.count() // shard_docs)))
    # Borders: quantiles of the ids.  A null id goes to the first shard.
    at = [i / shards for i in range(1, shards)]
    borders = sorted(set(docs.agg(F.percentile_approx(id_col, at, 100 * shards)).first()[0] or [])) if at else []
    shard = F.lit(0)
    if borders:
        listed = F.array(*[F.lit(b) for b in borders]).cast(f"array<{kind}>")
        shard = F.coalesce(F.size(F.filter(listed, lambda x: x <= F.col("id"))), F.lit(0))
    packed = encode(docs, tokenizer, bits, end_id, id_col, text_col, byte_level)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by shard, id and row; blocks are cut as documents come.
        now, block, first = None, 0, 0
        keys, held, ends = [], [], [0]

        def cut() -> dict:
            ids = np.concatenate(held)
            return {"shard": now, "block": block, "first": first, "n": len(ids), "bits": bits,
                    "doc_ids": list(keys), "ends": ends[1:], "packed": pack(ids, bits)}

        for b in batches:
            out = []
            missing = b["id"].isna().to_numpy()
            for i, (shard_, key, n, data) in enumerate(zip(b["shard"], b["id"], b["n"], b["packed"], strict=True)):
                if held and (shard_ != now or ends[-1] >= BLOCK):
                    out.append(cut())
                    block, first = block + 1, first + ends[-1]
                    keys, held, ends = [], [], [0]
                if shard_ != now:
                    now, block, first = shard_, 0, 0
                keys.append(None if missing[i] else key)
                held.append(unpack(data, n, bits))
                ends.append(ends[-1] + n)
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([cut()], columns=names)

    names = ["shard", "block", "first", "n", "bits", "doc_ids", "ends", "packed"]
    (packed.withColumn("shard", shard.cast("int")).repartitionById(shards, F.col("shard"))
     .sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "row")
     .mapInPandas(blocks, f"shard int, block bigint, first bigint, n bigint, bits int, doc_ids array<{kind}>, "
                          "ends array<bigint>, packed binary")
     .write.parquet(f"{path}/blocks"))
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n").alias("n"))
    # One row a shard, at most MAX_SHARDS.
    base = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("shard", F.coalesce(base, F.lit(0)).cast("bigint").alias("base")).write.parquet(f"{path}/starts")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, start, n_tokens, ids_crc32) of each document from the files; `start`
    counts the ids of all documents before it, `ids_crc32` is over its ids as
    little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                data = unpack(r.packed, r.n, r.bits).astype("<u4").tobytes()
                ends = np.array(r.ends, np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                yield pd.DataFrame({"doc_id": r.doc_ids, "shard": r.shard, "place": r.first + starts, "n_tokens": ends - starts,
                                    "ids_crc32": [zlib.crc32(data[4 * lo:4 * hi]) for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]})

    blocks = spark.read.parquet(f"{path}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"][6:-1]
    found = blocks.mapInPandas(run, f"doc_id {kind}, shard int, place bigint, n_tokens bigint, ids_crc32 bigint")
    return (found.join(spark.read.parquet(f"{path}/starts"), "shard")
            .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "shard"))


def ids_at(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Random access: `n` ids of the stream from the place `start` on (fewer at its end)."""
    starts = spark.read.parquet(f"{path}/starts")
    blocks = spark.read.parquet(f"{path}/blocks").join(F.broadcast(starts), "shard")  # at most MAX_SHARDS rows
    at = F.col("base") + F.col("first")
    out = []
    for r in blocks.where((at < start + n) & (at + F.col("n") > start)).select(at.alias("at"), "n", "bits", "packed").orderBy("at").collect():
        lo, hi = max(start, r["at"]), min(start + n, r["at"] + r["n"])
        out.append(unpack(r["packed"], hi - lo, r["bits"], lo - r["at"]))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
