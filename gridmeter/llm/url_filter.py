"""URL filters: a blocked Bloom filter before an exact hash join.

A rule is (host, path, verdict).  It fits its host and all subdomains if the
url's path starts with the rule's path; of the rules that fit, the longest
wins (host and path together; of two as long, the one with the longer host).  Every url gives a few candidate keys (each suffix of its host at a label
border, with each path prefix of a length that some rule has).  The Bloom
filter over the listed keys drops nearly all keys that no rule has, inside the
row and without a shuffle; what passes is joined exactly with the rules, which
removes the false positives.

The filter is blocked: one 512-bit block a key (eight 64-bit words, one bit
set in each), so a test reads eight neighbouring words.  Its size is bounded
by `max_blocks` (64 bytes a block) whatever the number of rules, so it may
travel as a literal; with more rules it only lets more keys through to the
join.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmeter.llm.common import ascii_lower, fresh
from gridmeter.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, measured_size

KEYS_PER_BLOCK = 32  # 16 bits a key
MAX_BLOCKS = 16_384  # 1 MiB
MAX_LENGTHS = 4_096
SALTS = 16


def url_host(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is no `://`."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end; empty if there is no `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def host_suffixes(labels: Column, sizes: list[int]) -> Column:
    """The suffixes of a host (its labels as an array) with so many labels: of `a.b.c` those of 1
    and 2 are `c` and `b.c`.  Only sizes that some rule has are made, so a host takes time with its length."""
    return F.transform(F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= F.size(labels)),
                       lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def _bits(key: Column) -> list[Column]:
    """The bit (as a long with one bit set) of a key in each of the eight words of its block."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int"))
            for i in range(8)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long")).cast("int")


class BloomFilter:
    """A blocked Bloom filter over the column `key` of `keys`, built by bit_or per block."""

    def __init__(self, keys: DataFrame, key: str = "key", max_blocks: int = MAX_BLOCKS):
        n = keys.count()
        self.blocks = max(1, min(max_blocks, -(-n // KEYS_PER_BLOCK)))
        block, bits = _block(F.col(key), self.blocks), _bits(F.col(key))
        filled = (keys.where(F.col(key).isNotNull()).select(block.alias("b"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
                  .groupBy("b").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]))
        words = ["0"] * (8 * self.blocks)
        for row in filled.collect():  # at most `max_blocks` rows
            words[8 * row["b"]:8 * row["b"] + 8] = [str(row[f"w{i}"]) for i in range(8)]
        # A constant expression: folded into one array literal.
        self.words = F.from_json(F.lit("[" + ",".join(words) + "]"), T.ArrayType(T.LongType()))

    def may_hold(self, key: Column) -> Column:
        at = _block(key, self.blocks) * 8
        tests = [F.get(self.words, at + i).bitwiseAND(bit) == bit for i, bit in enumerate(_bits(key))]
        return reduce(lambda a, b: a & b, tests)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with `host`, `path`, `rule` (host and path of the rule, else null) and `verdict`.

    `rules`: columns host, path, verdict (block or allow); hosts are compared
    in lower case.  If one (host, path) is listed twice, block wins.  Rules
    with a null or an empty host or a null path fit nothing.  A url that no
    rule fits gets `default`.  Null urls and urls without `://` have an empty
    host and path and so no rule.  Repeated rows are judged each; empty tables
    give empty results.  Columns of `pages` named like the four added ones are
    replaced; others stay as they are.
    """
    lengths_of = rules.where("host != '' and path is not null").select(
        ascii_lower(F.col("host")).alias("host"), "path", "verdict")
    listed = (lengths_of.groupBy(F.concat(F.col("host"), F.lit("\x00"), F.col("path")).alias("key"))
              .agg(F.max("verdict").alias("verdict")))  # "block" sorts after "allow"
    lengths = [r["n"] for r in lengths_of.select(F.length("path").alias("n")).distinct()
               .limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"rules have paths of more than {MAX_LENGTHS} different lengths")
    sizes = [r["n"] for r in lengths_of.select(F.size(F.split("host", r"\.")).alias("n")).distinct()
             .limit(MAX_LENGTHS + 1).collect()]
    if len(sizes) > MAX_LENGTHS:
        raise ValueError(f"rules have hosts of more than {MAX_LENGTHS} different numbers of labels")
    bloom = BloomFilter(listed)

    pages = pages.drop("host", "path", "rule", "verdict")
    given, uid, hits, key, labels = pages.columns, *(fresh(pages, n) for n in ("uid", "hits", "hit", "labels"))
    split = pages.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    split = split.withColumn(labels, F.split("host", r"\."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(host_suffixes(F.col(labels), sorted(sizes)), lambda h: F.transform(
        prefixes, lambda p: F.concat(h, F.lit("\x00"), p))))
    tested = split.withColumn(hits, F.when(F.col("host") != "", F.filter(keys, bloom.may_hold))
                              .otherwise(F.array().cast("array<string>")))
    out = [*given, "host", "path"]
    clear = tested.where(F.size(hits) == 0).select(
        *out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Possible hits: the exact join, then the longest rule of each row.  The row number is
    # made and used within this one flow.
    longest = F.max(F.struct(F.when(F.col("_v").isNotNull(), F.length(F.col(key))).alias("n"),
                             F.length(F.substring_index(F.col(key), "\x00", 1)).alias("host"),
                             F.when(F.col("_v").isNotNull(), F.col(key)).alias("key"), F.col("_v").alias("v"))).alias("best")
    possible = (tested.where(F.size(hits) > 0).withColumn(uid, F.monotonically_increasing_id())
                .select(F.struct(*[F.col(c) for c in out]).alias("row"), uid, F.explode(hits).alias(key)))
    exact = listed.select(F.col("key").alias(key), F.col("verdict").alias("_v"))
    # Rules of a proven size travel to the rows; more of them meet the rows by key, which
    # is salted by the row, as a third of all rows may have one (say, `com`).
    rows, size = measured_size(exact)
    if rows <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES:
        joined = possible.join(F.broadcast(exact), key, "left")
    else:
        salted = exact.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = possible.withColumn("_salt", F.pmod(F.xxhash64(uid), F.lit(SALTS)).cast("int")).join(
            salted.hint("shuffle_hash"), [key, "_salt"], "left")
    possible = (joined.groupBy(uid).agg(F.first("row").alias("row"), longest))
    found = possible.select("row.*", F.translate("best.key", "\x00", "").alias("rule"),
                            F.coalesce(F.col("best.v"), F.lit(default)).alias("verdict"))
    return clear.unionByName(found)
