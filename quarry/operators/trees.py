"""Histogram decision trees and forests as aggregations, a level at a time (M5).

Features become bin numbers once: a fine histogram per feature (``CELLS`` equal cells
between its least and greatest value) gives cut points at even shares of the rows. A level
then is one aggregation of (tree, node, feature, bin, class) counts: every row walks the
splits so far to its node, so rows are never shuffled or rewritten. Gini gains of all cuts
are windows over those counts, whose number is bounded by trees x nodes x features x bins
x classes; the best cut of each node (at most trees x 2^level rows) is all that reaches
the driver.

Bagging weights and each node's features are seeded hashes of ids, the same on any
cluster; the weights are drawn once and written beside the bins. Ties go to the first feature, then the lowest cut. A node splits while a cut gains
and both sides hold ``min_rows``; its class is its most frequent one, ties to the first.
Null features count as below every cut; rows without a label train nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import seeded_hash
from quarry.session import shared_path

CELLS = 1024


def cut_points(df: DataFrame, features: str, bins: int) -> list[list[float]]:
    """At most ``bins - 1`` ascending cut points per feature; a value's bin is the number of cuts at or below it."""
    values = df.select(F.posexplode(features).alias("f", "v")).where("v is not null")
    ends = values.groupBy("f").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(CELLS)
    cell = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(CELLS - 1))).otherwise(F.lit(0))
    counts = values.join(F.broadcast(ends), "f").select("f", "lo", "hi", "n", cell.cast("int").alias("cell")).groupBy("f", "lo", "hi", "n", "cell").agg(
        F.count(F.lit(1)).alias("c"))  # a row per feature, then per feature and cell
    upto = F.sum("c").over(Window.partitionBy("f").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    share = counts.withColumn("before", F.coalesce(upto, F.lit(0))).withColumn("bin", F.floor(F.col("before") * F.lit(bins) / F.col("n")))
    edges = share.where("bin > 0").groupBy("f", "bin", "lo", "hi").agg(F.min("cell").alias("cell"))
    edges = edges.select("f", (F.col("lo") + F.col("cell") * (F.col("hi") - F.col("lo")) / F.lit(CELLS)).alias("x")).distinct().collect()
    out: dict[int, list[float]] = {}
    for r in edges:
        out.setdefault(r["f"], []).append(r["x"])
    size = df.select(F.max(F.size(features)).alias("d")).first()["d"] or 0
    return [sorted(out.get(f, [])) for f in range(size)]


def constant(value: list, kind: str) -> Column:
    """A nested list as one literal, whatever its length: array() of literals folds, while from_json would be parsed again for every element."""
    def text(v) -> str:
        if isinstance(v, list):
            return f"array({', '.join(map(text, v))})"
        if isinstance(v, tuple):
            return f"struct({', '.join(map(text, v))})"
        return str(v) if isinstance(v, int) else f"{v!r}D" if math.isfinite(v) else f"double('{v}')"
    return F.expr(f"cast({text(value)} as {kind})")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, where a plain column would be computed again for every element that reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def binned(features: str | Column, cuts: list[list[float]]) -> Column:
    """array<int>: the bin of every feature."""
    table = constant(cuts, "array<array<double>>")
    return F.transform(features, lambda v, i: F.coalesce(F.size(F.filter(F.get(table, i), lambda x: x <= v)), F.lit(0)))


@dataclass
class Forest:
    """Splits by tree and heap number of the node (children of k: 2k + 1, 2k + 2)."""

    classes: list
    cuts: list[list[float]]
    trees: int
    depth: int
    splits: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)   # (tree, node) -> (feature, bins from here go right)
    leaves: dict[tuple[int, int], list[float]] = field(default_factory=dict)       # (tree, node) -> rows by class

    def _table(self) -> Column:
        width = 2 ** self.depth
        flat = [self.splits.get((t, k), (-1, 0)) for t in range(self.trees) for k in range(width - 1)]
        return constant(flat, "array<struct<f:int,b:int>>")

    def nodes(self, bins: Column) -> Column:
        """array<int>: the node of every tree in which a row ends."""
        width, table = 2 ** self.depth - 1, self._table()

        def walk(t: Column) -> Column:
            def down(k: Column, _: Column) -> Column:
                s = F.get(table, t * width + k)
                turn = F.when(F.get(bins, s["f"]) >= s["b"], 2).otherwise(1)
                return F.when(s["f"].isNull() | (s["f"] < 0), k).otherwise(2 * k + turn)
            return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), down)
        return F.transform(F.sequence(F.lit(0), F.lit(self.trees - 1)), walk) if self.depth else F.array_repeat(F.lit(0), self.trees)

    def predict(self, df: DataFrame, features: str, out: str = "prediction") -> DataFrame:
        """``out``: the class of the largest mean share over the trees' leaves, and ``votes`` with those shares (null without classes)."""
        if not self.classes:
            return df.withColumn("votes", F.lit(None).cast("array<double>")).withColumn(out, F.lit(None).cast("string"))
        many, width = len(self.classes), 2 ** (self.depth + 1) - 1

        def share(t: int, k: int) -> list[float]:
            rows = self.leaves.get((t, k)) or [0.0] * many
            return [x / (sum(rows) or 1.0) for x in rows]
        table = constant([share(t, k) for t in range(self.trees) for k in range(width)], "array<array<double>>")
        leaf = lambda at: F.transform(at, lambda k, t: F.get(table, t * width + k))
        mean = lambda rows: F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda c: F.round(F.aggregate(
            rows, F.lit(0.0), lambda a, v: a + F.get(v, c)) / F.lit(float(self.trees)), 9))
        at = df.withColumn("votes", bound(binned(features, self.cuts), lambda b: bound(self.nodes(b), lambda k: bound(leaf(k), mean))))
        names = F.array(*[F.lit(c) for c in self.classes])
        return at.withColumn(out, F.get(names, F.array_position("votes", F.array_max("votes")) - 1))


def _bags(id: str, trees: int, seed: int, bagging: bool) -> Column:
    """array<int>: how often a row counts in each tree, Poisson(1) by the inverse of its distribution at a seeded hash."""
    if not bagging:
        return F.array_repeat(F.lit(1), trees)

    def drawn(u: Column) -> Column:
        total, p, out = 0.0, 0.36787944117144233, F.lit(0)
        for k in range(6):
            total += p
            out = out + F.when(u >= F.lit(total), 1).otherwise(0)
            p /= k + 1
        return out
    # the lambda binds a tree's hash, so it is taken once for the six steps
    shares = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: seeded_hash(
        F.concat_ws(":", t.cast("string"), F.col(id).cast("string")), seed) / F.lit(float(1 << 32)))
    return F.transform(shares, drawn)


def grow(df: DataFrame, features: str, label: str, id: str, trees: int = 1, depth: int = 3, bins: int = 32, per_node: int | None = None,
         bagging: bool = False, min_rows: int = 1, seed: int = 1) -> Forest:
    """Grow ``trees`` trees of at most ``depth`` levels of splits; ``per_node`` features are tried at each node (None: all)."""
    spark = df.sparkSession
    known = df.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    cuts = cut_points(known, features, bins)
    classes = [r["y"] for r in known.select(F.col(label).alias("y")).distinct().orderBy("y").collect()]
    if not classes:
        return Forest([], cuts, trees, 0)
    names = F.array(*[F.lit(c) for c in classes])
    path = shared_path(spark, "trees")
    known.select((F.array_position(names, F.col(label)) - 1).cast("int").alias("y"),
                 binned(features, cuts).alias("bins"), _bags(id, trees, seed, bagging).alias("bags")).write.parquet(path)
    rows = spark.read.parquet(path)
    forest = Forest(classes, cuts, trees, 0)
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("t")
    for level in range(depth + 1):
        forest.depth = level
        at = rows.withColumn("_at", forest.nodes(F.col("bins"))).select("y", "bins", "bags", "_at", tree)
        at = at.select("t", F.get("_at", F.col("t")).alias("k"), "y", "bins", F.get("bags", F.col("t")).alias("w")).where("w > 0")
        at = at.where(F.col("k") >= 2 ** level - 1)  # others ended above
        for r in at.groupBy("t", "k").pivot("y", list(range(len(classes)))).agg(F.sum("w")).collect():  # a row per node
            forest.leaves[(r["t"], r["k"])] = [float(r[str(c)] or 0) for c in range(len(classes))]
        if level == depth:
            break
        nodes = [n for n in forest.leaves if n[1] >= 2 ** level - 1]
        for r in _best_cuts(at, nodes, len(cuts), per_node, min_rows, seed).collect():
            forest.splits[(r["t"], r["k"])] = (r["f"], r["b"])
        if not any(k >= 2 ** level - 1 for _, k in forest.splits):
            break
    return forest


def _best_cuts(at: DataFrame, nodes: Sequence[tuple[int, int]], features: int, per_node: int | None, min_rows: int, seed: int) -> DataFrame:
    """(t, k, f, b): the best cut of every node that has one; ``nodes``: the (t, k) of ``at``."""
    if per_node is not None and per_node < features:
        # a node's features: the smallest seeded hashes of (tree, node, feature); one row a node, and only they leave a row's bins
        key = lambda f: seeded_hash(F.concat_ws(":", F.col("t").cast("string"), F.col("k").cast("string"), f.cast("string")), seed + 1)
        ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(features - 1)), lambda f: F.struct(key(f).alias("h"), f.alias("f"))))
        spark = at.sparkSession
        table = spark.createDataFrame(sorted(nodes), "t int, k int").select(
            "t", "k", F.transform(F.slice(ranked, 1, per_node), lambda x: x["f"]).alias("tried"))
        tried = at.join(F.broadcast(table), ["t", "k"])
        each = tried.select("t", "k", "y", "w", F.explode(F.transform("tried", lambda f: F.struct(f.alias("f"), F.get(F.col("bins"), f).alias("b")))).alias("x"))
        each = each.select("t", "k", "y", "w", "x.f", "x.b").where("b is not null")
    else:
        each = at.select("t", "k", "y", "w", F.posexplode("bins").alias("f", "b"))
    counts = each.groupBy("t", "k", "f", "b", "y").agg(F.sum("w").cast("double").alias("c"))
    # left of a cut at b are the bins below b
    bins = counts.groupBy("t", "k", "f", "b").agg(F.map_from_entries(F.collect_list(F.struct("y", "c"))).alias("m"))
    cells = bins.join(counts.groupBy("t", "k", "f", "y").agg(F.sum("c").alias("all")), ["t", "k", "f"])
    here = F.coalesce(F.try_element_at("m", F.col("y")), F.lit(0.0))
    before = Window.partitionBy("t", "k", "f", "y").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sides = cells.select("t", "k", "f", "b", "y", "all", F.coalesce(F.sum(here).over(before), F.lit(0.0)).alias("l"))
    s = sides.groupBy("t", "k", "f", "b").agg(F.sum("l").alias("nl"), F.sum(F.col("all") - F.col("l")).alias("nr"), F.sum(F.col("l") * F.col("l")).alias("sl"),
                                             F.sum((F.col("all") - F.col("l")) * (F.col("all") - F.col("l"))).alias("sr"),
                                             F.sum("all").alias("n"), F.sum(F.col("all") * F.col("all")).alias("s"))
    # Gini: rows times impurity is n - sum of squares / n, so the gain is what the squares rise by
    gain = F.round(F.col("sl") / F.col("nl") + F.col("sr") / F.col("nr") - F.col("s") / F.col("n"), 6)
    s = s.where((F.col("nl") >= min_rows) & (F.col("nr") >= min_rows) & (F.col("nl") > 0) & (F.col("nr") > 0)).withColumn("g", gain).where("g > 0")
    best = F.row_number().over(Window.partitionBy("t", "k").orderBy(F.desc("g"), "f", "b"))
    return s.withColumn("r", best).where("r = 1").select("t", "k", "f", "b", "g")
