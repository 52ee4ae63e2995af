"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Sizes and targets.  A source's target is its weight's share of all words,
   capped at `max_epochs` times its size; the excess goes to the others by weight
   (water filling: one level so that every target is min(cap, level x weight)).
2. Blocks.  Documents are dealt by a hash of id and text into blocks of their
   source, so a source with a third of all rows is thousands of blocks, and
   no step sorts or collects its documents.
3. Quotas.  Each source takes all its blocks as often as its target holds its
   size, then, in hashed order, further blocks as they fit into the rest.  The
   quota of blocks is an exact integer.
4. Splitting tree.  The root holds every source's quota and all shards.  Each
   node splits its shards in two and draws how many of its blocks go left from
   the multivariate hypergeometric distribution (source by source), so each
   leaf is a random exact share of the whole quota.
5. Each shard draws its quota of each source as a run of the source's permuted
   block instances: runs are disjoint and cover the quota.  Within its shard a
   document instance has a hashed place (local shuffle).

All numbers are hashes of ids and the seed: reruns agree.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmeter.llm.common import WORD, fresh, text_or_empty, unit_hash
from gridmeter.session import materialize

BLOCK_WORDS = 1_000_000
LEAST_BLOCKS = 1_024  # so that small sources are dealt document by document
FILL_ROUNDS = 6


def default_weights(sources: DataFrame, source: str = "source") -> DataFrame:
    """Weights 1, 2, 3, repeating, over the distinct sources by code point, null last."""
    # One row per source; UTF-8 byte order is code point order.
    place = F.row_number().over(Window.orderBy(F.col(source).isNull(), source))
    return sources.select(source).distinct().select(source, ((place - 1) % 3 + 1).cast("double").alias("weight"))


def targets(sizes: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """(s, size, weight) per source -> with `target`; weights null or not positive get no share."""
    w = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    t = sizes.withColumn("_w", w).withColumn("_cap", F.col("size") * F.lit(max_epochs))
    every = Window.partitionBy()
    order = Window.orderBy(F.coalesce(F.try_divide("_cap", "_w"), F.lit(float("inf"))), "s")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # At each source: the level if it and all after it stayed below their caps.
    t = t.withColumn("_level", F.try_divide(
        F.sum("size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    # The true level is that of the first source which stays below its cap.
    below = (F.col("_w") > 0) & (F.col("_level") * F.col("_w") <= F.col("_cap"))
    t = t.withColumn("_at", F.row_number().over(order))
    t = t.withColumn("_l", F.min(F.when(below, F.struct("_at", F.col("_level").alias("l")))).over(every)["l"])
    return t.withColumn("target", F.when(F.col("_w") <= 0, 0.0).otherwise(
        F.coalesce(F.least(F.col("_cap"), F.col("_l") * F.col("_w")), F.col("_cap")))).drop("_w", "_cap", "_level", "_at", "_l")


def hypergeometric(good: str, bad: str, draws: str, u: str) -> str:
    """SQL: how many of `draws` (bigint) blocks drawn without replacement from `good` + `bad`
    are good, for the uniform number `u`.

    Inverse of the exact distribution, walked outward from the mode by the ratio of
    neighbouring terms, so nothing under- or overflows.  Terms further than 12
    deviations off are below the precision of a double (1e-31 of the largest).
    """
    lo, hi = f"greatest(0L, {draws} - {bad})", f"least({draws}, {good})"
    total = f"({good} + {bad})"
    mode = f"least({hi}, greatest({lo}, cast(floor(({draws} + 1.0D) * ({good} + 1.0D) / ({total} + 2.0D)) as bigint)))"
    width = (f"cast(ceil(12 * sqrt({draws} * 1.0D * {good} / greatest({total}, 1L) * {bad} / greatest({total}, 1L)) + 40) as bigint)")
    up = f"(({good} - k + 1.0D) * ({draws} - k + 1.0D) / (k * 1.0D * ({bad} - {draws} + k)))"        # p(k) / p(k - 1)
    down = f"((k + 1.0D) * ({bad} - {draws} + k + 1.0D) / (({good} - k) * 1.0D * ({draws} - k)))"    # p(k) / p(k + 1)

    def walk(m: str, ratio: str, ks: str, start: str, goal: str) -> str:
        # p: term; c: sum so far; at: the first k whose sum reaches the goal.
        return (f"aggregate({ks}, named_struct('p', 1.0D, 'c', {start}, 'at', cast(null as bigint)), (y, k) -> "
                f"named_struct('p', y.p * {ratio}, 'c', y.c + y.p * {ratio}, "
                f"'at', coalesce(y.at, if(y.c + y.p * {ratio} >= {goal}, k, null))))")

    def let(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    ups = f"if(m < least({hi}, m + w), sequence(m + 1, least({hi}, m + w)), cast(array() as array<bigint>))"
    downs = f"if(m > greatest({lo}, m - w), sequence(m - 1, greatest({lo}, m - w), -1L), cast(array() as array<bigint>))"
    above, below = walk("m", up, ups, "0.0D", "1e300D"), walk("m", down, downs, "0.0D", "1e300D")
    # The goal runs over the mode first, then upward, then downward.
    pick = (f"case when g <= 1.0D then m "
            f"when g <= 1.0D + a then coalesce({walk('m', up, ups, '1.0D', 'g')}.at, least({hi}, m + w)) "
            f"else coalesce({walk('m', down, downs, '1.0D + a', 'g')}.at, greatest({lo}, m - w)) end")
    return let("m", mode, let("w", width, let("a", f"{above}.c", let(
        "g", f"({u}) * (1.0D + a + {below}.c)", pick))))


def split_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(s, quota bigint) per source -> (s, shard, n, start): how many block instances of each
    source each shard gets, and the first of them.  Shards' totals differ by at most one.

    A row is a (node, source).  At each level every node splits; the sources of a
    node draw one after the other from what is left, which a running sum gives:
    the draw of a source given the earlier sources' draws is hypergeometric over
    itself against all later sources.
    """
    nodes = (quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("s", F.col("quota").alias("q")))).alias("qs"))
             .select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "qs"))
    draw = hypergeometric("e.q", "(x.rest - e.q)", "x.left", "pmod(xxhash64({seed}, lo, hi, e.s), 9007199254740992L) / 9007199254740992.0D"
                          .replace("{seed}", f"{seed}L"))
    width = 1
    while width < shards:
        # rest: blocks of this and later sources; left: draws that remain for them.
        step = (f"aggregate(qs, named_struct('rest', total, 'left', cast(round(total * 1.0D * (mid - lo) / (hi - lo)) as bigint), "
                f"'out', cast(array() as array<bigint>)), (x, e) -> transform(array({draw}), d -> "
                f"named_struct('rest', x.rest - e.q, 'left', x.left - d, 'out', concat(x.out, array(d))))[0]).out")
        split = (nodes.withColumn("mid", F.expr("if(hi - lo > 1, cast((lo + hi) div 2 as int), hi)"))
                 .withColumn("total", F.expr("aggregate(qs, 0L, (t, e) -> t + e.q)"))
                 .withColumn("d", F.expr(f"if(hi - lo > 1, {step}, transform(qs, e -> e.q))")))
        nodes = materialize(split.select(F.explode(F.expr(
            "filter(array(named_struct('lo', lo, 'hi', mid, 'qs', zip_with(qs, d, (e, n) -> named_struct('s', e.s, 'q', n))), "
            "named_struct('lo', mid, 'hi', hi, 'qs', zip_with(qs, d, (e, n) -> named_struct('s', e.s, 'q', e.q - n)))), "
            "n -> n.lo < n.hi)")).alias("n")).select("n.*"), "mix-tree")
        width *= 2
    leaves = nodes.select(F.col("lo").alias("shard"), F.explode("qs").alias("e")).select("shard", "e.s", F.col("e.q").alias("n"))
    start = F.sum("n").over(Window.partitionBy("s").orderBy("shard")) - F.col("n")
    return leaves.withColumn("start", start)


def _take(blocks: DataFrame, seed: int) -> DataFrame:
    """(s, block, words) of every block with target -> copies of each block to take."""
    order = unit_hash(F.lit(seed), F.col("s"), F.col("block"))
    t = (blocks.withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "size")), F.lit(0)))
         .withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))
         .withColumn("place", order).withColumn("more", F.lit(False)))
    by = Window.partitionBy("s")
    for _ in range(FILL_ROUNDS):
        # Blocks that still fit, in hashed order, as far as their running sum fits.
        gap = F.col("rest") - F.coalesce(F.sum(F.when(F.col("more"), F.col("words"))).over(by), F.lit(0))
        t = t.withColumn("gap", gap)
        fits = ~F.col("more") & (F.col("words") > 0) & (F.col("words") <= F.col("gap"))
        run = F.sum(F.when(fits, F.col("words"))).over(by.orderBy("place", "block").rowsBetween(Window.unboundedPreceding, 0))
        t = t.withColumn("run", run).withColumn("more", F.col("more") | (fits & (F.col("run") <= F.col("gap"))))
    # The last gap: one more block if that comes nearer.
    gap = F.col("rest") - F.coalesce(F.sum(F.when(F.col("more"), F.col("words"))).over(by), F.lit(0))
    t = t.withColumn("gap", gap)
    least = F.min(F.when(~F.col("more") & (F.col("words") > 0), F.struct("words", "block"))).over(by)
    t = t.withColumn("least", least)
    last = (F.col("block") == F.col("least.block")) & (F.col("least.words") - F.col("gap") < F.col("gap"))
    return t.select("s", "block", "words", (F.col("whole") + F.when(F.col("more") | F.coalesce(last, F.lit(False)), 1)
                                            .otherwise(0)).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", shards: int = 16, seed: int = 42, max_epochs: int = 3,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with `mix_size` (words), `mix_source_size`, `mix_target` (its source's) and
    `mix_places`: array of (shard, place), one for each time the mix takes the row
    (at most `max_epochs`; empty if never).  Row order within a shard is by place.

    `weights`: (source, weight); without it `default_weights`.  A null source is a
    source of its own; a source without a positive weight gets no words, and its words' share goes to the others.  Null ids and null
    texts are values like any other (size of a null text: 0).  Rows that repeat id
    and text share a block and so are taken together.  An empty table gives an
    empty result.  Columns of `docs` with these four names are replaced.
    """
    given = [c for c in docs.columns if c.lower() not in ("mix_size", "mix_source_size", "mix_target", "mix_places")]
    docs = docs.select(*given)
    s = F.struct(F.col(source_col).alias("source"))  # a struct, so that null equals null
    n_words = F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint")
    spread = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    sized = docs.select(s.alias("s"), n_words.alias("words"), spread.alias("spread"))
    # Per (source, fine block): a first reduction that later gets its block count.
    narrow = materialize(sized, "mix-sizes")
    sizes = narrow.groupBy("s").agg(F.sum("words").alias("size"))
    weighed = (weights if weights is not None else default_weights(narrow.select("s.source"), "source"))
    weighed = weighed.select(F.struct(F.col(weighed.columns[0]).alias("source")).alias("s"), F.col("weight"))
    plan = targets(sizes.join(weighed, "s", "left"), float(max_epochs)).withColumn(
        "blocks", F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("size") / block_words)).cast("bigint"))
    plan = materialize(plan, "mix-plan")  # one row per source
    block = F.pmod(F.col("spread"), F.col("blocks"))
    blocks = (narrow.join(plan, "s").groupBy("s", block.alias("block"))
              .agg(F.sum("words").alias("words"), F.first("size").alias("size"), F.first("target").alias("target")))
    taken = materialize(_take(blocks, seed), "mix-take")
    quotas = taken.groupBy("s").agg(F.sum("copies").cast("bigint").alias("quota"))
    tree = split_tree(quotas, shards, seed)
    # Block instances in permuted order, each with its rank among its source's.
    instances = taken.where("copies > 0").select("s", "block", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    rank = F.row_number().over(Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed + 1), "s", "block", "copy"), "block", "copy"))
    runs = tree.where("n > 0").select("s", "shard", F.explode(F.expr("sequence(start + 1, start + n)")).alias("rank"))
    dealt = (instances.withColumn("rank", rank.cast("bigint")).join(runs, ["s", "rank"])
             .groupBy("s", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("got")))
    found = materialize(dealt, "mix-dealt")

    size, key, at, n_blocks, own, got = (fresh(docs, n) for n in ("size", "source", "spread", "blocks", "block", "got"))
    marked = docs.withColumns({size: n_words, key: s, at: spread})
    p = plan.select(F.col("s").alias(key), F.col("size").alias("mix_source_size"), F.col("target").alias("mix_target"),
                    F.col("blocks").alias(n_blocks))
    d = found.select(F.col("s").alias(key), F.col("block").alias(own), F.col("got").alias(got))
    place = F.transform(F.coalesce(F.col(got), F.array().cast("array<struct<copy:int,shard:int>>")), lambda g: F.struct(
        g["shard"].alias("shard"), F.xxhash64(F.lit(seed + 2), F.col(at), g["copy"]).alias("place")))
    return (marked.join(p, key).withColumn(own, F.pmod(F.col(at), F.col(n_blocks)))
            .join(d, [key, own], "left")
            .select(*given, F.col(size).alias("mix_size"), "mix_source_size", "mix_target", place.alias("mix_places")))


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of `mix`'s result as often as it was taken, with its
    columns and `mix_shard`, sorted by shard and place within partitions by shard.  A
    column named `mix_shard` is replaced."""
    columns = [c for c in mixed.columns if c.lower() not in ("mix_places", "mix_shard")]
    taken, place = fresh(mixed, "taken"), fresh(mixed, "place")
    return (mixed.where(F.size("mix_places") > 0).select(*columns, F.explode("mix_places").alias(taken))
            .select(*columns, F.col(f"{taken}.shard").alias("mix_shard"), F.col(f"{taken}.place").alias(place))
            .repartitionByRange("mix_shard", place).sortWithinPartitions("mix_shard", place).drop(place))
