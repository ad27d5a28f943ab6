"""Random forests from cells: rows are summed by the bins of all features, with the sums of every tree's bootstrap sample beside them.

Each row is drawn for each tree a Poisson(1) number of times, as in Spark's forests. A tree needs of a cell only how many draws it has there and the
sum of their targets, so these are added up in one pass (rows are sorted by cell within partitions, which may split a cell: sums of its parts add up just
the same). All trees then grow together, one aggregate of (tree, node, feature, bin) a level, over cells instead of rows.
Splits lower the variance most among a third of the features, drawn anew for each node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.missing import null_if_nan
from tidemark.operators.boosting import Binned, bin_number, feature_edges
from tidemark.session import pin_columns


@dataclass
class Forest:
    """Trees as arrays (tree, node): the children of node i are 2 i + 1 and 2 i + 2; feature -1 marks a leaf."""

    features: list[str]
    edges: list[list[float]]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, df: DataFrame) -> Column:
        feature, cut, value = self.feature, self.cut, self.value

        @F.pandas_udf("double")
        def mean_of_leaves(*bins: pd.Series) -> pd.Series:
            x = np.stack([b.to_numpy() for b in bins], axis=1)
            return pd.Series(sum(value[t][nodes_of(feature[t], cut[t], x)] for t in range(len(value))) / len(value))

        return mean_of_leaves(*[bin_number(present(df, c), e) for c, e in zip(self.features, self.edges)])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.predict(df))


def present(df: DataFrame, name: str) -> Column:
    """The value of a feature; a gap is an error, as for Spark's models."""
    value = null_if_nan(df, name).cast("double")
    return F.coalesce(value, F.raise_error(F.lit(f"missing value in {name}")).cast("double"))


def nodes_of(feature: np.ndarray, cut: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The leaf of each row of bins ``x``."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(int(np.log2(len(feature) + 1)) - 1):
        own = feature[node]
        node = np.where(own >= 0, 2 * node + 1 + (x[rows, np.maximum(own, 0)] > cut[node]), node)
    return node


def bagged_cells(df: DataFrame, features: Sequence[str], target: str, trees: int = 20, seed: int = 42, max_bins: int = 32) -> Binned:
    """Cells as of ``binned_cells``, maybe in several parts, with the draws (``w``) and the sums of drawn targets (``s``) of each tree."""
    features = list(features)
    known = df.where(null_if_nan(df, target).isNotNull())
    edges = feature_edges(known, features, max_bins)
    names = [f"b{i}" for i in range(len(features))]

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy() for c in batch.columns[:-1]], axis=1)
            y = batch.columns[-1].to_numpy()
            starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]).any(axis=1)])
            draws = rng.poisson(1.0, (len(y), trees)).astype(np.float64)
            w, s = np.add.reduceat(draws, starts), np.add.reduceat(draws * y[:, None], starts)
            n = np.diff(np.r_[starts, len(y)])
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * trees), pa.array(v.ravel())) for v in (w, s)]
            columns = [*[pa.array(c) for c in x[starts].T], pa.array(n), pa.array(np.add.reduceat(y, starts) / n), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n", "target", "w", "s"])

    rows = known.select(
        *[bin_number(present(known, c), e).alias(b) for b, c, e in zip(names, features, edges)], F.col(f"`{target}`").cast("double").alias("target")
    )
    schema = ", ".join([*[f"{b} short" for b in names], "n long, target double, w array<double>, s array<double>"])
    # rebalanced, not repartitioned: a cell of very many rows may be split
    return Binned(features, edges, pin_columns(rows.hint("rebalance", *names).sortWithinPartitions(*names).mapInArrow(bag, schema)))


def level_sums(cells: DataFrame, feature: np.ndarray, cut: np.ndarray, first: int, width: int, features: int, bins: int) -> np.ndarray:
    """Draws and sums of targets per (tree, node of the level, feature, bin)."""
    trees = len(feature)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, trees, features, width * bins))
        for batch in batches:
            x = np.stack([c.to_numpy() for c in batch.columns[:features]], axis=1)
            w, s = (c.flatten().to_numpy().reshape(-1, trees) for c in batch.columns[features:])
            for t in range(trees):
                node = nodes_of(feature[t], cut[t], x) - first
                inside = (node >= 0) & (w[:, t] > 0)
                at, xs, ws, ss = node[inside] * bins, x[inside], w[inside, t], s[inside, t]
                for f in range(features):
                    place = at + xs[:, f]
                    total[0, t, f] += np.bincount(place, ws, width * bins)
                    total[1, t, f] += np.bincount(place, ss, width * bins)
        some = np.flatnonzero(total[0].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(v.ravel()[some]) for v in total]], names=["place", "w", "s"])

    parts = cells.select(*[f"b{i}" for i in range(features)], "w", "s").mapInArrow(summed, "place long, w double, s double")
    # one row per tree, node, feature and bin, whatever the size of the table
    found = parts.groupBy("place").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).toPandas()
    out = np.zeros((2, trees * features * width * bins))
    out[:, found["place"].to_numpy(np.int64)] = found["w"], found["s"]
    return out.reshape(2, trees, features, width, bins).transpose(0, 1, 3, 2, 4)


def fit_forest(binned: Binned, depth: int = 6, seed: int = 42) -> Forest:
    """Grow all trees of the bootstrap samples in ``binned`` level by level."""
    features, bins = len(binned.features), max((len(e) for e in binned.edges), default=0) + 2
    first = binned.cells.select(F.size("w")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    trees, rng = first[0], np.random.default_rng(seed)
    shape = (trees, 2 ** (depth + 1) - 1)
    feature, cut, value = np.full(shape, -1), np.zeros(shape, np.int64), np.zeros(shape)
    open_nodes = np.zeros(shape, bool)
    open_nodes[:, 0] = True
    for level in range(depth):
        start, width = 2**level - 1, 2**level
        sums = level_sums(binned.cells, feature, cut, start, width, features, bins)
        for t, i in zip(*np.nonzero(open_nodes[:, start : start + width])):
            node, (w, s) = start + i, sums[:, t, i]
            whole_w, whole_s = w[0].sum(), s[0].sum()
            if not whole_w:
                continue  # no draws: the whole tree is empty
            if node == 0:
                value[t, 0] = whole_s / whole_w
            some = np.sort(rng.choice(features, max(1, -(-features // 3)), replace=False))
            left_w, left_s = np.cumsum(w[some], axis=1), np.cumsum(s[some], axis=1)
            right_w, right_s = whole_w - left_w, whole_s - left_s
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_s**2 / left_w + right_s**2 / right_w - whole_s**2 / whole_w
            gain = np.where((left_w > 0.5) & (right_w > 0.5), gain, -np.inf)
            best = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if gain[best] <= 1e-12 * whole_s**2 / whole_w:
                continue
            feature[t, node], cut[t, node] = some[best[0]], best[1]
            for child, child_w, child_s in ((2 * node + 1, left_w, left_s), (2 * node + 2, right_w, right_s)):
                value[t, child], open_nodes[t, child] = child_s[best] / child_w[best], True
    return Forest(binned.features, binned.edges, feature, cut, value)
