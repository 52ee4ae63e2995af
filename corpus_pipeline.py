"""The corpus pipeline: quality filter, exact dedup, near-dedup, mixing, byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.llm import bpe, exact_dedup, mixing, quality, simhash
from gridmeter.llm.common import read_table
from gridmeter.session import materialize

RANKS = "byte_bpe_multi_50k.tiktoken"


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more (fitted on labels outside the held-out fold)."""
    return quality.reject(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (4-word shingles, 4 bits), one document stays."""
    return simhash.keep_one(docs, width=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (weights 1, 2, 3 over the sources, at most three epochs)."""
    return mixing.mixed_rows(mixing.mix(docs)).select(*docs.columns)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the digest of the bytes they decode to."""
    import public_tokenizers

    ids = bpe.read_ranks(public_tokenizers.path(RANKS))
    encoded = bpe.encode(docs, bpe.pair_table(ids), public_tokenizers.PATTERN)
    return bpe.decode(encoded, ids).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", filter_quality),
    ("exact_dedup", dedup_exact),
    ("simhash_near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("bpe", encode_bpe),
]

#: SQL cannot express fingerprints, the mix or the classifier; see tests/llm/test_models.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
