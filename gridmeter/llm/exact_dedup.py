"""Exact dedup by a persistent digest index.

The index is a table (digest, first_id), bucketed and sorted by digest.  A
batch of new documents is reduced to one row per digest (partial aggregation,
so a group of copies holding a third of the rows shrinks before the shuffle),
anti-joined with the index by a sort-merge join, and the digests not yet there
are appended.  Texts are read once and never shuffled: only 32-byte digests
and ids move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmeter.llm.common import SPACE_RUN, fresh, text_or_empty
from gridmeter.session import materialize


def normalised(text_col: str) -> Column:
    """Every run of white space (space, tab to carriage return) as one space; null as empty."""
    return F.regexp_replace(text_or_empty(text_col), SPACE_RUN, " ")


class DigestIndex:
    """A digest table in the session's catalog, bucketed and sorted by digest.

    `path` places it (so that a later session can open it by the same path and
    `buckets`); without it the warehouse holds it.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, path: str | None = None,
                 id_type: str = "bigint"):
        self.spark, self.name, self.buckets = spark, name, buckets
        place = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, first_id {id_type}, first_uid BIGINT, "
                  f"batch STRING) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {buckets} BUCKETS{place}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Index `docs` and return one row per row of it: id, `keep_id`,
        `group_size` (rows of this batch with the same text), `kept`,
        `text_sha256`.

        Of equal texts the row with the smallest id stays (null ids come last);
        if an earlier batch holds the text, none of this batch stays and
        `keep_id` is the earlier row's id.  Of rows that repeat the same id and
        text, one stays.  Null and white-space-only texts are texts like any
        other.  An empty batch gives no rows.  Other columns are not read.

        The batch's digests are written once to the shared folder, so that the
        anti-join, the append and the answer see the same rows, and a lost
        executor costs no second reading of texts.
        """
        batch = uuid.uuid4().hex
        digests = materialize(docs.select(
            F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"),
            F.unhex(F.sha2(normalised(text_col), 256)).alias("digest")), "digests")
        first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "uid")).alias("first")
        groups = digests.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size"))
        new = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        (new.select("digest", F.col("first.id").alias("first_id"), F.col("first.uid").alias("first_uid"),
                    F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.mode("append").insertInto(self.name))
        # The answer: group sizes and kept rows per digest, then one join back to the rows.
        # Both sides of that join are shuffled, so AQE can split a hot digest.
        sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        known = materialize(self.table().hint("merge").join(sizes, "digest"), "digest-groups")
        return (digests.join(known.hint("merge"), "digest")
                .select(F.col("id").alias(id_col), F.col("first_id").alias("keep_id"), "group_size",
                        ((F.col("batch") == batch) & (F.col("uid") == F.col("first_uid"))).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"), "uid"))


def new_index(spark: SparkSession, buckets: int | None = None, id_type: str = "bigint") -> DigestIndex:
    """A fresh index under a name of its own; buckets as many as shuffle partitions unless given."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex[:12]}", buckets, id_type=id_type)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decisions of `DigestIndex.add` for one table against a fresh index."""
    kind = dict(docs.dtypes)[id_col]
    return new_index(docs.sparkSession, id_type=kind).add(docs, id_col, text_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with the columns of `docs`; of rows that
    repeat the same id and text one stays.  The decisions are joined back on
    (id, digest); a struct key makes null ids equal to each other."""
    key, digest = fresh(docs, "key"), fresh(docs, "digest")
    kept = (dedup(docs, id_col, text_col).where("kept")
            .select(F.struct(F.col(id_col).alias("id")).alias(key), F.unhex("text_sha256").alias(digest)))
    marked = (docs.withColumn(digest, F.unhex(F.sha2(normalised(text_col), 256)))
              .withColumn(key, F.struct(F.col(id_col).alias("id"))))
    return marked.join(kept, [key, digest], "left_semi").dropDuplicates([key, digest]).drop(key, digest)
