"""Gradient boosting from sums of gradients and Hessians, with a learned direction for missing values.

Every numeric feature is cut once at quantiles (one aggregate of sketches over all features) and kept as a small bin number, 0 for a missing value,
so features need no imputer. Rows with the same bins in all features get the same score in every step, so they are summed once into one cell with its
number of rows and the sum of its targets; gradients and Hessians are exact on cells, and all steps go over these. A tree grows level by level, or by its
best leaves: each step is one aggregate of gradients, Hessians and rows by
(leaf, feature, bin), combined before its shuffle and bounded by leaves x features x bins whatever the number of rows. From these sums the driver
takes the best split of each leaf, trying for every cut to send missing values left and right. In training, trees are applied to cells as column
expressions; rows are cut into bins and scored in arrays, since so many nested conditions are not compiled and take many times as long a row.

The running scores are written to the shared folder every ``KEEP`` trees, so plans stay short and a lost executor costs a few trees of scoring.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.missing import null_if_nan
from tidemark.session import pin, pin_for_reuse

KEEP = 4  # trees between two written copies of the running scores
ACCURACY = 10_000


@dataclass
class Node:
    """A leaf with a value, or a cut: rows at or below ``edge`` go left, missing values where ``missing_left`` says."""

    value: float = 0.0
    feature: int = -1
    cut: int = 0
    edge: float = 0.0
    missing_left: bool = False
    gain: float = 0.0
    rows: int = 0
    left: int = -1
    right: int = -1


@dataclass
class Boosted:
    features: list[str]
    edges: list[list[float]]
    base: float
    objective: str
    trees: list[list[Node]] = field(default_factory=list)

    def score(self, df: DataFrame) -> Column:
        """Raw score of each row (log-odds for the logistic objective)."""
        if not self.trees:
            return F.lit(self.base)
        base, trees = self.base, [tree_arrays(tree) for tree in self.trees]

        @F.pandas_udf("double")
        def raw(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(float) for c in columns], axis=1)
            rows = np.arange(len(x))
            total = np.full(len(x), base)
            for feature, edge, missing_left, left, right, value in trees:
                node = np.zeros(len(x), np.int64)
                while (inner := feature[node] >= 0).any():
                    own = x[rows, np.maximum(feature[node], 0)]
                    goes_left = np.where(np.isnan(own), missing_left[node], own <= edge[node])
                    node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
                total += value[node]
            return pd.Series(total)

        return raw(*[null_if_nan(df, name).cast("double") for name in self.features])

    def predict(self, df: DataFrame) -> Column:
        return link(self.score(df), self.objective)

    def importance(self) -> dict[str, float]:
        """Share of the gain of all cuts per feature."""
        gains = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for node in tree:
                if node.feature >= 0:
                    gains[self.features[node.feature]] += node.gain
        total = sum(gains.values()) or 1.0
        return {name: gain / total for name, gain in gains.items()}


def tree_arrays(tree: list[Node]) -> tuple[np.ndarray, ...]:
    return tuple(np.array([getattr(node, name) for node in tree]) for name in ("feature", "edge", "missing_left", "left", "right", "value"))


def link(score: Column, objective: str) -> Column:
    return 1 / (1 + F.exp(-score)) if objective == "logistic" else score


def leaf_value(tree: list[Node], goes_left, at: int = 0) -> Column:
    node = tree[at]
    if node.feature < 0:
        return F.lit(node.value)
    return F.when(goes_left(node), leaf_value(tree, goes_left, node.left)).otherwise(leaf_value(tree, goes_left, node.right))


def leaf_of(tree: list[Node], goes_left, wanted: set[int], at: int = 0) -> Column:
    """Number of the row's leaf, null for leaves that are not ``wanted``."""
    node = tree[at]
    if node.feature < 0:
        return F.lit(at if at in wanted else None).cast("int")
    return F.when(goes_left(node), leaf_of(tree, goes_left, wanted, node.left)).otherwise(leaf_of(tree, goes_left, wanted, node.right))


def feature_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Ascending cuts per feature from one aggregate of quantile sketches: at most ``max_bins`` - 1, below the largest value."""
    probs = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[
        F.struct(F.percentile_approx(null_if_nan(df, c).cast("double"), probs, ACCURACY).alias("q"), F.max(null_if_nan(df, c).cast("double")).alias("top"))
        .alias(f"f{i}") for i, c in enumerate(features)
    ]).first()
    return [sorted({q for q in (r["q"] or []) if math.isfinite(q) and q < r["top"]}) for r in row]


def bin_number(value: Column, edges: Sequence[float]) -> Column:
    """1 + the number of edges below the value; 0 for a missing value. Searched in arrays: as nested conditions the code grows too long to be compiled."""
    cuts = np.array(edges, float)

    @F.pandas_udf("short")
    def number(x: pd.Series) -> pd.Series:
        v = x.to_numpy(float)
        return pd.Series(np.where(np.isnan(v), 0, np.searchsorted(cuts, v) + 1).astype(np.int16))

    return number(value)


@dataclass
class Binned:
    """Rows with a target, summed by the bins of all features: columns ``b0``, ``b1`` ..., ``n`` (rows) and ``target`` (their mean)."""

    features: list[str]
    edges: list[list[float]]
    cells: DataFrame


def binned_cells(df: DataFrame, features: Sequence[str], target: str, max_bins: int = 32) -> Binned:
    """Cut every feature at quantiles and sum the rows of equal bins: at most the product of the numbers of bins, and never more than there are rows."""
    features = list(features)
    known = df.where(null_if_nan(df, target).isNotNull())
    edges = feature_edges(known, features, max_bins)
    names = [f"b{i}" for i in range(len(features))]
    binned = known.select(
        F.col(f"`{target}`").cast("double").alias("target"),
        *[bin_number(null_if_nan(known, c).cast("double"), e).alias(b) for b, c, e in zip(names, features, edges)],
    )
    return Binned(features, edges, pin_for_reuse(binned.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("target"))))


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    left: tuple[float, float, float]  # gradient, Hessian, rows
    right: tuple[float, float, float]


def best_split(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, penalty: float, min_hessian: float, min_rows: int) -> Split | None:
    """Best cut of one leaf from sums per (feature, bin); bin 0 holds missing values. Ties go to the first feature, cut and to the left.

    The gain is G_l^2 / (H_l + penalty) + G_r^2 / (H_r + penalty) - G^2 / (H + penalty).
    """
    whole = np.array([x[0].sum() for x in (grad, hess, rows)])
    parent = whole[0] ** 2 / (whole[1] + penalty)
    best: Split | None = None
    for missing_left in (True, False) if (rows[:, 0] > 0).any() else (True,):
        left = np.stack([np.cumsum(x[:, 1:], axis=1) + (x[:, :1] if missing_left else 0) for x in (grad, hess, rows)])
        right = whole[:, None, None] - left
        allowed = (np.minimum(left[1], right[1]) >= min_hessian) & (np.minimum(left[2], right[2]) >= max(min_rows, 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / (left[1] + penalty) + right[0] ** 2 / (right[1] + penalty) - parent
        gain = np.where(allowed, gain, -np.inf)
        feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        found = float(gain[feature, cut])
        if np.isfinite(found) and (best is None or found > best.gain * (1 + 1e-9)):
            sides = (tuple(map(float, side[:, feature, cut])) for side in (left, right))
            best = Split(found, int(feature), int(cut) + 1, missing_left, *sides)
    return best


def gradients(score: Column, target: Column, objective: str) -> tuple[Column, Column]:
    if objective == "squared":
        return score - target, F.lit(1.0)
    if objective == "logistic":
        chance = link(score, objective)
        return chance - target, chance * (1 - chance)
    raise ValueError(f"unknown objective: {objective}")


def leaf_sums(
    cells: DataFrame, leaf: Column, score: Column, features: int, bins: int, objective: str, leaves: Sequence[int]
) -> dict[int, np.ndarray]:
    """Sums (gradient, Hessian, rows) per (feature, bin) of the given leaves, from one aggregate."""
    g, h = gradients(F.col("__score"), F.col("target"), objective)
    unfolded = cells.select(leaf.alias("leaf"), score.alias("__score"), "target", "n", *[f"b{i}" for i in range(features)]).where(
        F.col("leaf").isNotNull()
    ).select("leaf", "n", (g * F.col("n")).alias("g"), (h * F.col("n")).alias("h"), F.posexplode(F.array(*[f"b{i}" for i in range(features)])).alias("feature", "bin"))
    # one row per leaf, feature and bin, whatever the size of the table
    sums = unfolded.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    out = {leaf: np.zeros((3, features, bins)) for leaf in leaves}
    for r in sums.collect():
        out[r["leaf"]][:, r["feature"], r["bin"]] = r["g"], r["h"], r["n"]
    return out


def fit_boosted(
    df: DataFrame, features: Sequence[str], target: str, objective: str = "squared", trees: int = 20, depth: int = 4,
    learning_rate: float = 0.3, max_bins: int = 32, penalty: float = 1.0, min_gain: float = 0.0, min_hessian: float = 1.0, min_rows: int = 1,
    max_leaves: int | None = None, binned: Binned | None = None,
) -> Boosted:
    """Fit on the rows that have a target; ``binned`` hands over their cells (with edges of its own) where several fits share them.

    Without ``max_leaves`` every leaf of a level is split as long as its gain exceeds ``min_gain``; with it, the best half of
    the waiting leaves is split in each step until there are so many leaves or no gain is left (``depth`` still bounds it).
    """
    if binned is None:
        binned = binned_cells(df, features, target, max_bins)
    features, edges, cells = list(binned.features), binned.edges, binned.cells
    mean = cells.agg(F.sum(F.col("target") * F.col("n")) / F.sum("n")).first()[0]
    if mean is None:
        return Boosted(features, edges, 0.0, objective)
    base = mean
    if objective == "logistic":
        bounded = min(max(mean, 1e-6), 1 - 1e-6)
        base = math.log(bounded / (1 - bounded))
    model = Boosted(features, edges, base, objective)
    bins = max(len(e) for e in edges) + 2  # missing, and one more than there are edges
    scored, unwritten = cells.withColumn("score", F.lit(base)), 0
    score = F.col("score")

    def goes_left(node: Node) -> Column:
        number = F.col(f"b{node.feature}")
        inside = number <= F.lit(node.cut)
        return inside if node.missing_left else inside & (number > 0)

    for _ in range(trees):
        tree = [Node()]
        waiting, ready, leaves = {0: 0}, {}, 1  # leaf -> depth; leaf -> (split, depth); number of leaves
        while waiting or ready:
            if waiting:
                sums = leaf_sums(scored, leaf_of(tree, goes_left, set(waiting)), score, len(features), bins, objective, list(waiting))
                for leaf, (g, h, n) in sums.items():
                    split = best_split(g, h, n, penalty, min_hessian, min_rows)
                    if split is not None and split.gain > max(min_gain, 1e-12):
                        ready[leaf] = (split, waiting[leaf])
            chosen = sorted(ready, key=lambda leaf: (-ready[leaf][0].gain, leaf))
            if max_leaves is not None:
                chosen = chosen[: max(0, min(max_leaves - leaves, (len(chosen) + 1) // 2))]
            if not chosen:
                break
            waiting = {}
            for leaf in chosen:
                split, level = ready.pop(leaf)
                node, own = tree[leaf], edges[split.feature]
                node.feature, node.cut, node.missing_left, node.gain = split.feature, split.cut, split.missing_left, split.gain
                node.edge = own[split.cut - 1] if split.cut <= len(own) else math.inf  # beyond all edges: only missing values go right
                node.left, node.right = len(tree), len(tree) + 1
                tree += [Node(value=-learning_rate * g / (h + penalty), rows=int(n)) for g, h, n in (split.left, split.right)]
                leaves += 1
                if level + 1 < depth:  # deeper leaves have their values from their parent's sums already
                    waiting |= {node.left: level + 1, node.right: level + 1}
        if len(tree) == 1:
            break  # no cut gains anything
        model.trees.append(tree)
        score, unwritten = score + leaf_value(tree, goes_left), unwritten + 1
        if unwritten == KEEP:
            scored, unwritten = pin(scored.withColumn("score", score)), 0
            score = F.col("score")
    return model


def with_prediction(df: DataFrame, model: Boosted, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, model.predict(df))
