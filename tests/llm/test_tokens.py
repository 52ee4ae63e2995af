"""Byte-level BPE, token files and token counts against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridmeter.llm import bpe, chunks, queries, token_counts, token_files
from tests.llm.conftest import SF, odd_rows

JSON = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "b", "c", "th", "ing", " ", " ", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "é", "1", "23", ".", "'s",
            "　", "中", "​", "😀", "<|endoftext|>"]


def texts(n, seed, most=14):
    g = random.Random(seed)
    return ["".join(g.choice(ALPHABET) for _ in range(g.randrange(most))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def table(ranks):
    return bpe.pair_table(ranks)


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_chunks_are_encoded_alike(encoding, library):
    for t in texts(4_000, 1):
        cut = chunks.chunks(t)
        assert "".join(cut) == t
        assert [i for c in cut for i in encoding.encode_ordinary(c)] == encoding.encode_ordinary(t)
        if "<|" not in t:
            assert [i for c in cut for i in library.encode(c, add_special_tokens=False).ids] == library.encode(t, add_special_tokens=False).ids


def test_bpe_query_against_the_library(spark, docs, encoding):
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op8_bpe(spark, SF).collect()}
    assert got == want


def test_bpe_odd_texts(spark, odd, ranks, table, encoding):
    more = spark.createDataFrame(list(enumerate(texts(500, 2), 100)), "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionAll(more)
    # Blocks of a few texts: words come again in later blocks.
    coded = bpe.decode(bpe.encode(docs, table, public_tokenizers.PATTERN, block_bytes=64), ranks)
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in coded.collect()), key=str)
    want = sorted(((r["doc_id"], encoding.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in docs.collect()), key=str)
    assert got == want


def test_decode_unknown_and_null(spark, ranks):
    rows = spark.createDataFrame([(1, [0, 10**6]), (2, None), (3, []), (4, [1, None]), (5, [0, 1])], "doc_id long, ids array<int>")
    pieces = {i: p for p, i in ranks.items()}
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, ranks).collect()}
    assert got == {1: None, 2: None, 3: b"", 4: None, 5: bytearray(pieces[0] + pieces[1])}


def test_bpe_empty(empty, ranks, table):
    assert bpe.decode(bpe.encode(empty, table, public_tokenizers.PATTERN), ranks).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1_003, dtype=np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == (1_003 * bits + 7) // 8
    assert (token_files.unpack(data, 1_003, bits) == ids).all()
    assert (token_files.unpack(data, 100, bits, 877) == ids[877:977]).all()


def test_an_id_beyond_the_bits_raises():
    with pytest.raises(ValueError, match="70000 does not fit into 16 bits"):
        token_files.pack(np.array([1, 70_000], np.uint32), 16)


def stream(rows, library):
    """(doc_id, start, n, crc) in order, and all ids."""
    out, ids = [], []
    for key, text in rows:
        own = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, len(ids), len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        ids += own
    return out, np.array(ids, np.uint32)


def test_token_file_query(spark, docs, library):
    want, _ = stream([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()], library)
    got = queries.op1_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_token_files_many_shards_and_random_access(spark, docs, odd, library, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 700)
    some = docs.select("doc_id", "text").where("doc_id < 60").unionAll(odd.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    token_files.write(some, f"{scratch}/t", JSON, 50_257, shard_docs=9)
    got = token_files.read(spark, f"{scratch}/t").collect()
    assert len({r["shard"] for r in got}) > 3
    rows = sorted(((r["doc_id"], r["text"]) for r in some.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    # Rows of one id (or none) stand in the order of reading, so compare without it.
    plain, _ = stream(rows, library)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(k), n, c) for k, _, n, c in plain)
    spans = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    keys = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    one = next(r for r in got if r["doc_id"] == 30)
    ids = token_files.ids_at(spark, f"{scratch}/t", one["start"], one["n_tokens"])
    assert zlib.crc32(ids.astype("<u4").tobytes()) == one["ids_crc32"]
    assert len(token_files.ids_at(spark, f"{scratch}/t", spans[-1][1] - 5, 100)) == 5


def test_token_files_empty(spark, empty, scratch):
    token_files.write(empty, f"{scratch}/t", JSON, 50_257)
    assert token_files.read(spark, f"{scratch}/t").count() == 0


def test_memory_of_chunks(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 50)
    tokens = token_files.Tokens(JSON)
    for i in range(40):
        some = texts(30, 100 + i)
        assert [x.tolist() for x in tokens.ids(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_count_query(spark, docs, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_token_counts(spark, SF).collect()}
    want = {}
    for r in docs.collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        want[r["doc_id"]] = (len((r["text"] or "").encode()), n, n > 512)
    assert got == want


def test_counts_of_spliced_chunks(spark, odd, library):
    g = random.Random(3)
    long = [" ".join(g.choice(["thing", "été", "12 34", "a\n\nb", "..", "中文", "<|endoftext|>", "x" * 50]) for _ in range(400)) for _ in range(12)]
    long += ["a" * 3_000, "ab  " * 800, "=" * 500 + " " + "x y" * 300, "\n" * 900 + "word " * 50, "中" * 700]
    docs = odd.select("doc_id", "text").unionAll(spark.createDataFrame(list(enumerate(long, 100)), "doc_id long, text string"))
    got = token_counts.count_tokens(docs, JSON, chunk=256, overlap=8).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert len(got) == len(odd_rows()) + len(long)


def test_counts_empty(empty):
    assert token_counts.count_tokens(empty, JSON).count() == 0


def test_merges_of_many_words_at_once(docs, ranks, table):
    encoded = bpe.encode(docs, table, public_tokenizers.PATTERN)
    assert encoded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    g = random.Random(5)
    words = [bytes(g.choices(b"abcdest  \xc3\xa9", k=g.randint(1, 30))) for _ in range(300)] + [b"a" * 500, b"x"]

    def one(word):
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    byte = np.array([ranks[bytes([i])] | table.flag for i in range(256)], np.int64)
    sizes, ids = bpe.merge(words, table, byte)
    want = [one(w) for w in words]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_chunks_by_key():
    g = random.Random(11)
    for _ in range(3_000):
        text = "".join(g.choices(["a", "bc", " ", "  ", "\n", "\t", "\u00e9", "\u3000", "\x85"], k=g.randint(0, 9)))
        keys = chunks.keys(text)
        assert [chunks.chunk(k) for k in keys] == chunks.chunks(text)
        assert len(set(keys)) == len(set(chunks.chunks(text)))
