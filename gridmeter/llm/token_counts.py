"""Token counts by overlap resynchronisation.

Documents up to `CHUNK` characters are counted whole.  Longer ones are cut into
chunks that overlap; each chunk is encoded on its own, with offsets.  Two chunks are
spliced at a place of their overlap where both have a token border that is proven
stable: before a white-space character that follows another character, where the
tokenizer's pattern always cuts, so what stands left and right of it is encoded alike
in the chunk and in the whole text.  Counts up to the splice come from the left chunk,
after it from the right one.  If an overlap has no common stable border, the
document is cut again with overlaps twice as wide, until one chunk is the whole text.

Chunks of one document are rows of their own, so a huge document is encoded by many
tasks, and no task holds more than a chunk of it at a time.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.llm.common import text_or_empty
from gridmeter.llm.token_files import Tokens
from gridmeter.session import materialize

CHUNK = 32_768
OVERLAP = 512


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def whole_counts(path: str, byte_level: bool):
    """A pandas UDF: tokens of each whole text (see token_files.Tokens)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gc.disable()  # nothing here makes cycles, and the memory has many objects to look through
        tokens = Tokens(path, byte_level)
        for texts in batches:
            out: list[int] = []
            for at in range(0, len(texts), 2_048):
                out += tokens.counts(texts.iloc[at:at + 2_048].tolist())
            yield pd.Series(out, dtype="int64")

    return run


#: A blank after something that no tokenizer takes for white space.
_BORDER = r"(?<=[^\s\x1c-\x1f\x85\u180e\u200b\ufeff])[ \n\t\r]"


def stable_borders(text: str, encoding, lo: int, hi: int) -> tuple[list[int], list[int]]:
    """(places, tokens before each) of the stable borders of an encoded chunk from `lo` to
    before `hi`.  No token crosses a border, so the tokens before it are those that begin
    before it: the token that holds the last character before the border is the last."""
    places, before = [], []
    for m in regex.finditer(_BORDER, text, pos=max(lo, 1), endpos=min(hi, len(text))):
        last = encoding.char_to_token(m.start() - 1)
        if last is not None:
            # Several tokens may share a character's bytes: count on to the last of them.
            while last + 1 < len(encoding) and encoding.token_to_chars(last + 1)[0] < m.start():
                last += 1
            places.append(m.start())
            before.append(last + 1)
    return places, before


def chunk_counts(path: str, overlap: int):
    """A pandas UDF over (start, n_chars, text) of chunks: their tokens, and the stable borders
    (places in the whole text, tokens before them) in the first and last `overlap` characters."""
    kind = T.StructType([T.StructField("tokens", T.LongType()), *[
        T.StructField(c, T.ArrayType(T.LongType())) for c in ("left_at", "left_n", "right_at", "right_n")]])

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        library = _library(path)
        for starts, texts in batches:
            rows = []
            for start, text in zip(starts, texts, strict=True):
                e = library.encode_batch([text], add_special_tokens=False)[0]
                left, left_n = stable_borders(text, e, 0, overlap)
                right, right_n = stable_borders(text, e, len(text) - overlap, len(text))
                rows.append((len(e), [start + p for p in left], left_n, [start + p for p in right], right_n))
            yield pd.DataFrame(rows, columns=["tokens", "left_at", "left_n", "right_at", "right_n"])

    return run


#: Folds a document's chunks: n tokens so far, up to the place `at`; ok while every pair has met.
_SPLICE = """
aggregate(slice(parts, 2, size(parts)),
  named_struct('n', 0L, 'from', 0L, 'last', parts[0], 'ok', true),
  (s, c) -> aggregate(
    array(array_min(filter(array_intersect(s.last.right_at, c.left_at), x -> x >= s.last.start))), s,
    (t, m) -> if(not t.ok or m is null, named_struct('n', t.n, 'from', 0L, 'last', c, 'ok', false),
      named_struct('n', t.n + t.last.right_n[cast(array_position(t.last.right_at, m) as int) - 1] - t.from,
                   'from', c.left_n[cast(array_position(c.left_at, m) as int) - 1], 'last', c, 'ok', true))),
  s -> if(s.ok, s.n + s.last.tokens - s.from, null))
"""


def cutter(width: int, overlap: int):
    """For mapInPandas: each long text as rows of its chunks; every chunk but the last has
    `width` characters and shares `overlap` with the next."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                starts = range(0, max(1, len(r.text) - overlap), width - overlap)
                n_bytes = len(r.text.encode("utf-8", "surrogatepass"))
                for at in range(0, len(starts), 64):
                    some = starts[at:at + 64]
                    yield pd.DataFrame({"id": r.id, "row": r.row, "n_bytes": n_bytes, "start": list(some),
                                        "part": [r.text[s:s + width] for s in some]})

    return run


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP, byte_level: bool = True) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row, as the tokenizers library counts the whole text.

    Null and empty texts have no bytes and no tokens.  Null and repeated ids and
    repeated rows are counted each.  An empty table gives an empty result.  Other
    columns are not read.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    short = rows.where(F.length("text") <= chunk).select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"), whole_counts(tokenizer, byte_level)(F.col("text")).alias("n_tokens"))
    # Long texts are written once, with a number of their own: rows of later rounds are told apart by it.
    todo = materialize(rows.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    done, kind = [], dict(rows.dtypes)["id"]
    width, wide = chunk, overlap
    while not todo.isEmpty():
        cut = todo.select("id", "row", "text").mapInPandas(cutter(width, wide), f"id {kind}, row bigint, n_bytes bigint, start bigint, part string")
        parts = (cut.repartition(F.col("row"), F.col("start"))
                 .withColumn("c", chunk_counts(tokenizer, wide)(F.col("start"), F.col("part"))))
        joined = (parts.groupBy("row").agg(F.first("id").alias("id"), F.first("n_bytes").alias("n_bytes"), F.sort_array(
            F.collect_list(F.struct("start", "c.tokens", "c.left_at", "c.left_n", "c.right_at", "c.right_n"))).alias("parts"))
            .select("row", "id", "n_bytes", F.expr(_SPLICE).alias("n_tokens")))
        counted = materialize(joined, "long-counts")
        done.append(counted.where("n_tokens is not null").select("id", "n_bytes", "n_tokens"))
        failed = counted.where("n_tokens is null").select("row")
        todo = todo.join(failed, "row", "left_semi")
        # Wider overlaps, and chunks wide enough to hold them.
        wide *= 2
        width = max(width, 4 * wide)
    out = short
    for d in done:
        out = out.unionAll(d)
    return out.withColumnRenamed("id", id_col)
