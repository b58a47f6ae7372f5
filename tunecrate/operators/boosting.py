"""Second-order boosted trees for binary labels, with an L2 penalty on leaf values.

A level of a tree takes one aggregation: gradients and hessians are summed per (node, feature,
bin), map-side first, so a shuffle holds at most nodes x features x bins rows whatever the
number of samples. Running sums over the bins give every cut's gain; the best cut per node,
at most two to the power of the level rows, reaches the driver, where the trees are kept.
Samples never move; margins are cut off from their lineage every few rounds.

Defined cases: rows with null label or null features teach nothing; a null value goes left,
NaN right; no rows give no trees and margin 0; ties of gain (9 decimals) take the first
feature, then the lowest cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.functions import measures
from tunecrate.session import cut_lineage

LEAST_GAIN = 1e-6


@dataclass
class Tree:
    """Nodes are numbered 1, then 2n and 2n + 1 below n. ``splits``: node -> (feature, bin, cut); smaller values go left."""

    splits: dict[int, tuple[int, int, float]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def sql(self, test: Callable[[int, int, float], str], leaf: Callable[[int], str], node: int = 1) -> str:
        if node not in self.splits:
            return leaf(node)
        left, right = (self.sql(test, leaf, 2 * node + i) for i in (0, 1))
        return f"CASE WHEN {test(*self.splits[node])} THEN {left} ELSE {right} END"

    def value(self, test: Callable[[int, int, float], str]) -> Column:
        return F.expr(self.sql(test, lambda node: f"{self.leaves[node]!r}D"))


def _by_bin(feature: int, bin_: int, cut: float) -> str:
    return f"_bins[{feature}] < {bin_}"


def _number(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"double('{x!r}')"


def _by_value(feature: int, bin_: int, cut: float) -> str:
    return f"coalesce(features[{feature}] < {_number(cut)}, true)"


def bin_edges(samples: DataFrame, bins: int) -> list[list[float]]:
    """Ascending cuts of each feature: approximate quantiles, the smallest only to part null from the rest.

    At most ``bins`` + 1 numbers a feature reach the driver.
    """
    values = samples.select(F.posexplode("features").alias("feature", "value")).withColumn("nan", F.coalesce(F.isnan("value"), F.lit(False)))
    shares = [i / bins for i in range(bins + 1)]
    quantiles = F.percentile_approx(F.when(~F.col("nan"), F.col("value")), shares, 100 * bins)
    found = values.groupBy("feature").agg(
        F.array_sort(F.array_distinct(quantiles)).alias("cuts"), F.bool_or(F.col("value").isNull()).alias("nulls")
    )
    cuts = {r["feature"]: (r["cuts"] or [])[0 if r["nulls"] else 1 :] for r in found.collect()}
    return [cuts.get(i, []) for i in range(max(cuts, default=-1) + 1)]


def _binned(edges: list[list[float]]) -> Column:
    """Number of a feature's cuts that its value reaches; 0 for null."""
    one = "size(filter(array({cuts}), e -> e <= features[{i}]))"
    return F.expr("array(" + ", ".join(one.format(cuts=", ".join(map(_number, c)), i=i) if c else "0" for i, c in enumerate(edges)) + ")")


def _cuts(rows: DataFrame, tree: Tree, level: int, l2: float, least: float) -> DataFrame:
    """(node, g, h, cut): sums of each open node, and its best cut or null."""
    node = F.expr(tree.sql(_by_bin, str)).alias("node")
    p = measures.sigmoid(F.col("_margin"))
    own = rows.select(node, (p - F.col("label")).alias("g"), (p * (1 - p)).alias("h"), "_bins").where(F.col("node") >= 2**level)
    cells = own.select("node", "g", "h", F.posexplode("_bins").alias("feature", "bin"))
    cells = cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    every = Window.partitionBy("node", "feature")
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.select(
        "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(every).alias("g"), F.sum("h").over(every).alias("h"),
    )
    score = lambda g, h: g * g / (h + l2)
    gl, hl, g, h = map(F.col, ("gl", "hl", "g", "h"))
    gain = (score(gl, hl) + score(g - gl, h - hl) - score(g, h)) / 2
    allowed = (hl >= least) & (h - hl >= least) & (gain > LEAST_GAIN)
    cut = F.when(allowed, F.struct("feature", "bin", "gl", "hl"))
    order = F.when(allowed, F.struct(F.round(gain, 9), -F.col("feature"), -F.col("bin")))
    first = F.min_by(F.struct("g", "h"), F.struct("feature", "bin"))
    return sums.groupBy("node").agg(first.alias("total"), F.max_by(cut, order).alias("cut"))


def _grow(rows: DataFrame, edges: list[list[float]], depth: int, eta: float, l2: float, least: float) -> Tree:
    tree, sums = Tree(), {}
    for level in range(depth):
        found = _cuts(rows, tree, level, l2, least).collect()  # at most 2 ** level nodes
        for r in found:
            node, (g, h) = r["node"], sums.setdefault(r["node"], tuple(r["total"]))
            if r["cut"] is not None:
                feature, bin_, gl, hl = r["cut"]
                tree.splits[node] = (feature, bin_ + 1, edges[feature][bin_])
                sums[2 * node], sums[2 * node + 1] = (gl, hl), (g - gl, h - hl)
        if not any(r["cut"] is not None for r in found):
            break
    tree.leaves = {n: -eta * g / (h + l2) for n, (g, h) in sums.items() if n not in tree.splits}
    return tree


def boost(
    samples: DataFrame, rounds: int = 15, depth: int = 5, eta: float = 1.0, l2: float = 2.5,
    bins: int = 256, least_hessian: float = 1.0, every: int = 5,
) -> list[Tree]:
    """Trees fitted to (label 0 or 1, features array). A side of a cut holds at least ``least_hessian``.

    Leaf values are ``-eta * g / (h + l2)``. Margins are written every ``every`` rounds.
    """
    known = samples.select(F.col("label").cast("double").alias("label"), "features").dropna()
    edges = bin_edges(known, bins)
    if not edges:
        return []
    rows = cut_lineage(known.select("label", _binned(edges).alias("_bins"), F.lit(0.0).alias("_margin")))
    trees: list[Tree] = []
    for done in range(1, rounds + 1):
        trees.append(_grow(rows, edges, depth, eta, l2, least_hessian))
        if done < rounds:
            rows = rows.withColumn("_margin", F.col("_margin") + trees[-1].value(_by_bin))
            rows = cut_lineage(rows) if done % every == 0 else rows
    return trees


def boosted_margin(df: DataFrame, trees: list[Tree], out: str = "prob") -> DataFrame:
    """Adds ``margin`` (sum of leaf values) and ``prob`` = sigmoid(margin); both null where ``features`` is null."""
    margin = F.lit(0.0)
    for tree in trees:
        margin = margin + tree.value(_by_value)
    scored = df.withColumn("margin", F.when(F.col("features").isNotNull(), margin))
    return scored.withColumn(out, measures.sigmoid(F.col("margin")))
