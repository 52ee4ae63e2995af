"""The queries of this folder's operators, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.llm import (
    ann, bpe, exact_dedup, extraction, langid, merkle, mixing, quality, simhash, spelling, token_counts, token_files,
    url_filter,
)
from gridmeter.llm.common import LOWER, UPPER, ascii_lower, crc_fold, read_table
from gridmeter.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_50k.json", vocabulary: int = 50_257) -> DataFrame:
    """Every document's place, length and checksum, read back from the bit-packed files."""
    import public_tokenizers

    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex[:12]}")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write(docs, path, public_tokenizers.path(name), vocabulary, end_id=0)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document (weights 1, 2, 3 over the sources, at most three epochs)."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.size("mix_places") * F.col("mix_size")).alias("taken"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays of each group of equal texts."""
    found = exact_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds other than remainder 2."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(crc_fold("doc_id", 4))
    protos = langid.prototypes(docs.where(~held))
    found = langid.predict(docs.select("doc_id", "text"), protos)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the folds other than remainder 0."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~quality.held_out()))
    scored = quality.score_all(docs, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found of every hundredth vector."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


#: The rules of op7, fixed by its contract: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH rules(rh, rp, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + r"""),
u AS (
  SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS uid FROM pages),
s AS (
  SELECT page_id, uid,
         translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM u),
best AS (
  SELECT uid, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v
  FROM s JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY uid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN best USING (uid)
"""


def op8_bpe(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    import public_tokenizers

    ids = bpe.read_ranks(public_tokenizers.path(name))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded_digests(bpe.encode(docs, bpe.pair_table(ids), public_tokenizers.PATTERN), ids)


def encoded_digests(encoded: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    both = bpe.decode(encoded, ids)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str, name: str = "byte_bpe_50k.json") -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    counts = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(name))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (4-word shingles, 4 bits)."""
    found = simhash.near_groups(read_table(spark, sf_dir, "documents"), width=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.train()).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the manifest, and whether it stands after a fifth of the texts was changed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(crc_fold("doc_id", 5) == 0, merkle.leaf([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in columns]))
    folded = merkle.text_of(merkle.folded(F.col("path"), F.coalesce("changed", "leaf")))
    root = merkle.text_of(F.col("root"))
    return merkle.manifest(docs, [F.col(c) for c in columns], tampered, columns=[
        F.col("doc_id"), merkle.text_of(F.col("leaf")).alias("leaf"), merkle.text_of(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root")]).withColumn("verified", F.col("folded_root") == F.col("root"))


def _merkle_sql(levels: int = 8, arity: int = 16) -> str:
    """Levels written out (enough for arity ** levels documents of a source); every node's path is its own siblings
    and its parent's path."""
    field = lambda v: f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')"
    row = lambda text: " || ".join(field(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))
    steps = "list_reduce(range(8), lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, ascii(d)))"
    parts = [f"""
d AS (
  SELECT *, coalesce('=' || source, '') AS tree, sha256({row('text')}) AS leaf,
         sha256({row(f"translate(text, '{UPPER}', '{LOWER}')")}) AS changed,
         xor(list_reduce(string_split(doc_id::VARCHAR, ''), lambda c, d: {steps}, 4294967295::BIGINT), 4294967295) % 5 = 0 AS tampered
  FROM documents),
a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx, leaf AS h FROM d)"""]

    def climb(name: str) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""
{name}{k + 1} AS (
  SELECT tree, idx // {arity} AS idx, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) GROUP BY ALL)""")
        return out

    def paths(name: str) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""
{name}s{k} AS (
  SELECT tree, idx, n,
         coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k})
  WINDOW r AS (PARTITION BY tree, idx // {arity} ORDER BY idx))""")
        return out

    def path_of(name: str, idx: str, tree: str) -> tuple[str, str]:
        joins = " ".join(f"JOIN {name}s{k} AS {name}j{k} ON {name}j{k}.tree = {tree} AND {name}j{k}.idx = {idx} // {arity ** k}"
                         for k in range(levels))
        steps = ", ".join(f"CASE WHEN {name}j{k}.n > 1 THEN {{'l': {name}j{k}.l, 'r': {name}j{k}.r}} END" for k in range(levels))
        return joins, steps

    parts += climb("a")
    parts.append(f"""
b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, h, tree AS grp FROM a{levels}),
b0h AS (SELECT * FROM b0)""")
    parts += [c.replace("FROM b0)", "FROM (SELECT tree, idx, h FROM b0))") for c in climb("b")] + paths("a") + paths("b")
    low, low_steps = path_of("a", "p.idx", "p.tree")
    high, high_steps = path_of("b", "g.idx", "''")
    return "WITH " + ",".join(parts) + f""",
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS idx FROM d),
w AS (
  SELECT doc_id, leaf, g.h AS subroot, t.h AS root,
         CASE WHEN tampered THEN changed ELSE leaf END AS now,
         list_filter([{low_steps}, {high_steps}], lambda x: x IS NOT NULL) AS path
  FROM p JOIN b0h AS g ON g.grp = p.tree JOIN b{levels} AS t ON true {low} {high})
SELECT doc_id, leaf, subroot, root,
       sha256(list_aggregate(list_transform(path, lambda x: x.l || x.r), 'string_agg', '')) AS proof_sha256,
       list_reduce(list_transform(path, lambda x: x), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}},
                   {{'l': now, 'r': ''}}).l AS folded_root,
       folded_root = root AS verified
FROM w
"""


OP12_SQL = _merkle_sql()


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word's more frequent spelling one edit away, after one run in 97 lost a letter."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(docs, least_length=5, least_n=3, times=2, drop=97)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_files, op2_mixing, op3_exact_dedup, op4_language_id, op5_quality, op6_nearest, op7_url_filter, op8_bpe,
    op9_token_counts, op10_simhash, op11_extraction, op12_merkle, op13_spelling)}
ORACLES: dict[str, str] = {"op3_exact_dedup": OP3_SQL, "op7_url_filter": OP7_SQL, "op12_merkle": OP12_SQL}
