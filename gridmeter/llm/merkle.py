"""Merkle manifest of a table: every row's proof against one root.

Rows are leaves of a tree per group (say, source), in the order of their ids; the
trees' roots are the leaves of one more tree.  A parent hashes its `arity`
consecutive children (the last run may hold fewer, even one).

1. Leaves are hashed where the rows are read; from then on only digests move.
2. Places in a tree come from a range partitioning by (group, id): rows of a
   partition are numbered in it, and the counts of the partitions, summed in order,
   give each its first place.  So a group of any size is numbered by many tasks.
3. Each level is a sibling-shift self-join: every node computes the indices of its
   siblings (XOR for arity 2, else its slot shifted round the run) and is joined
   with the nodes at those indices by (tree, index); the slot-zero rows emit the
   parents.
4. Proofs go down the levels: a node's proof is its own siblings and its parent's
   proof, joined by (tree, parent index), where each key has at most `arity` rows.
   So no key is hot, though a third of all rows may lie below one subroot.

Digests travel as 32 bytes and are hashed as their hexadecimal text.  Each level is
written to the shared folder, so a lost executor costs no earlier level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmeter.session import drop_path, materialize


def text_of(digest: Column) -> Column:
    """A digest, or several one after another, as lower-case hexadecimal text."""
    return F.lower(F.hex(digest))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf(values: list[Column]) -> Column:
    """Digest of the values, each as `-` if null, else its bytes in UTF-8, `:` and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
             for v in values]
    return hashed(F.concat(*parts))


class Levels:
    """The levels of trees and the scratch tables that hold them."""

    def __init__(self, arity: int = 16):
        if arity < 2:
            raise ValueError("a parent has two children or more")
        self.arity, self.paths = arity, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        out, path = materialize(df, f"merkle-{name}", with_path=True)
        self.paths.append(path)
        return out

    def placed(self, rows: DataFrame, *order: str) -> DataFrame:
        """`rows` with their place `idx` in their `tree`, in the order of the columns
        `order`, and the tree's size `n`."""
        spark = rows.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = self.keep(rows.repartitionByRange(parts, "tree", *order).withColumn("part", F.spark_partition_id()), "dealt")
        tree = Window.partitionBy("tree")
        # One row per tree and partition.
        first = (dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
                 .select("tree", "part", (F.sum("rows").over(tree.orderBy("part")) - F.col("rows")).alias("base"),
                         F.sum("rows").over(tree).alias("n")))
        own = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)) - 1
        return dealt.withColumn("own", own).join(first, ["tree", "part"]).withColumn("idx", F.col("base") + F.col("own")).drop(
            "part", "base", "own")

    def siblings(self, nodes: DataFrame) -> DataFrame:
        """Each node with the digests before (`left`) and after it (`right`) in its run."""
        a, idx = self.arity, F.col("idx")
        if a == 2:
            shifts = F.array(idx.bitwiseXOR(F.lit(1).cast("bigint")))
        else:
            slot = idx % a
            shifts = F.transform(F.sequence(F.lit(1), F.lit(a - 1)), lambda k: idx - slot + (slot + k) % a)
        shifted = (nodes.select("tree", F.col("idx").alias("from"), F.col("node").alias("sibling"), "n",
                                F.explode(shifts).alias("idx")).where("idx < n").drop("n"))
        # The join is on (tree, idx), so its rows are grouped where they lie.
        keep = nodes.columns
        found = (nodes.join(shifted.hint("merge"), ["tree", "idx"], "left").groupBy(*keep)
                 .agg(F.array_sort(F.collect_list(F.when(F.col("from").isNotNull(), F.struct("from", "sibling")))).alias("s")))

        def side(before: bool) -> Column:
            own = F.filter("s", lambda x: (x["from"] < idx) if before else (x["from"] > idx))
            return F.aggregate(own, F.lit(b""), lambda got, x: F.concat(got, x["sibling"]))

        return found.withColumns({"left": side(True), "right": side(False)}).drop("s")

    def parents(self, level: DataFrame) -> DataFrame:
        """The parents that the slot-zero rows of a level emit."""
        a = self.arity
        return level.where(F.col("idx") % a == 0).select(
            "tree", F.expr(f"idx div {a}").alias("idx"), F.expr(f"(n + {a - 1}) div {a}").alias("n"),
            hashed(F.concat(text_of(F.col("node")), text_of(F.col("right")))).alias("node"))

    def build(self, leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
        """Levels of all trees from their placed leaves (columns tree, idx, n, node and more),
        each with `left` and `right`, and the roots (tree, node, tall: levels below)."""
        levels, roots = [], []
        nodes, most = leaves, leaves.agg(F.max("n")).first()[0] or 0
        while True:
            roots.append(nodes.where("n = 1").select("tree", "node", F.lit(len(levels)).alias("tall")))
            if most <= 1:
                break
            levels.append(self.keep(self.siblings(nodes.where("n > 1")), "level"))
            nodes = self.parents(levels[-1])
            most = -(-most // self.arity)
        return levels, reduce(DataFrame.unionAll, roots)

    def proofs(self, leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
        """The rows of `leaves` with their `path` and the other columns of `tops`, which has one
        row per tree: tree, height and the `path` of its root."""
        rest = [c for c in tops.columns if c not in ("tree", "height")]
        parents = tops.where(F.col("height") == len(levels)).select("tree", F.lit(0).cast("bigint").alias("up"), *rest)
        for k in reversed(range(len(levels))):
            own = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
            keep = ["tree", "idx"] if k else leaves.columns
            found = (levels[k].withColumn("up", F.expr(f"idx div {self.arity}")).join(parents.hint("merge"), ["tree", "up"])
                     .select(*keep, own, *[c for c in rest if c != "path"]))
            if k == 0:
                # The leaf of a tree of its own has no siblings.
                alone = leaves.where("n = 1").join(tops.drop("height"), "tree")
                return found.unionAll(alone.select(*found.columns))
            ended = tops.where(F.col("height") == k).select("tree", F.lit(0).cast("bigint").alias("idx"), *rest)
            parents = self.keep(found.unionAll(ended.select(*found.columns)), "proofs").withColumnRenamed("idx", "up")
        return leaves.join(tops.drop("height"), "tree")


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf's digest `start` gives with the siblings of `path`."""
    return F.aggregate(path, start, lambda node, x: hashed(F.concat(text_of(x["left"]), text_of(node), text_of(x["right"]))))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as hexadecimal text."""
    return text_of(F.aggregate(path, F.lit(b""), lambda got, x: F.concat(got, x["left"], x["right"])))


def manifest(docs: DataFrame, values: list[Column], changed: Column | None = None, id_col: str = "doc_id",
             group_col: str = "source", arity: int = 16, columns: list[Column] | None = None) -> DataFrame:
    """One row per row of `docs`: id, `leaf`, `subroot`, `root` (binary digests), `path` (array
    of the siblings `left` and `right` of each level, digests one after another, from the
    leaf to the root) and `changed`; or `columns` computed from these.  The result is
    a table in the shared folder; the tables of the levels are emptied.

    `values` are what a leaf hashes; `changed` is a digest to carry along (of a row as
    found later, to be folded against the path), null where there is none.  Groups are
    ordered by their text's bytes, a null group first; a group of one row is its leaf.
    Leaves ascend by id, null ids first, rows of one id by their digests (which rows with
    equal digests may share in any order).  Null and empty values have digests of their
    own.  An empty table gives no rows.  Only the columns of `values`, id and group
    are read; other columns are left out.
    """
    work = Levels(arity)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    none = F.lit(None).cast("binary")
    # The row number tells repeated rows apart when they are dealt out.
    leaves = work.keep(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf(values).alias("node"),
                                   (none if changed is None else changed).alias("changed"),
                                   F.monotonically_increasing_id().alias("row")), "leaves")
    placed = work.keep(work.placed(leaves, "id", "node", "row").drop("row"), "placed")
    levels, roots = work.build(placed)
    subroots = work.keep(roots, "subroots")
    # The tree over the subroots; its leaves are in the order of the groups.
    top = work.keep(work.placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node", F.col("tall").alias("height")), "group"),
                    "top")
    top_levels, top_root = work.build(top)
    empty_path = F.array().cast("array<struct<left: binary, right: binary>>")
    heads = top_root.select("tree", F.col("tall").alias("height"), empty_path.alias("path"), F.col("node").alias("root"))
    tops = (work.proofs(top, top_levels, heads)
            .select(F.col("group").alias("tree"), "height", "path", F.col("node").alias("subroot"), "root"))
    tops = work.keep(tops, "tops")
    found = (work.proofs(placed, levels, tops)
             .select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path", "changed"))
    out = materialize(found.select(*columns) if columns else found, "merkle-manifest")
    for path in work.paths:
        drop_path(docs.sparkSession, path)
    return out
