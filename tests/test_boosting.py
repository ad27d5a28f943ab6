"""Boosting with missing values: splits against brute force, scores against bins, and errors against a fit on filled gaps."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting as bo


def brute_split(columns, g, h, edges, penalty, min_rows):
    """Best gain over all features, edges and sides of the missing values."""
    best = -math.inf
    total = g.sum() ** 2 / (h.sum() + penalty)
    for x, own in zip(columns, edges):
        for edge, left_missing in itertools.product([*own, math.inf], (True, False)):
            left = np.where(np.isnan(x), left_missing, x <= edge)
            if left.sum() < min_rows or (~left).sum() < min_rows:
                continue
            gain = sum(g[m].sum() ** 2 / (h[m].sum() + penalty) for m in (left, ~left)) - total
            best = max(best, gain)
    return best


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(8)
    n = 600
    a, b = rng.integers(0, 12, n).astype(float), rng.normal(size=n)
    a[rng.random(n) < 0.3] = np.nan
    y = np.where(np.isnan(a), 8.0, a) + np.where(b > 0.3, 5, 0) + rng.normal(size=n) * 0.1
    rows = [(i, float(p) if not math.isnan(p) else None, float(q), float(r), 1.0) for i, (p, q, r) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, "k int, a double, b double, y double, fixed double").repartition(5), (a, b, y)


def test_first_split_equals_brute_force(spark, sample):
    df, (a, b, y) = sample
    model = bo.fit_boosted(df, ["a", "b", "fixed"], "y", trees=1, depth=1, learning_rate=1.0, max_bins=16, min_rows=20)
    root, left, right = model.trees[0]
    g, h = y.mean() - y, np.ones(len(y))
    assert root.gain == pytest.approx(brute_split([a, b, np.ones(len(a))], g, h, model.edges, 1.0, 20))
    assert left.rows + right.rows == len(y) and min(left.rows, right.rows) >= 20
    assert model.edges[2] == []


@pytest.mark.parametrize("max_leaves", [None, 6])
def test_scores_follow_the_trees(spark, sample, max_leaves):
    df, (a, b, y) = sample
    model = bo.fit_boosted(df, ["a", "b"], "y", trees=6, depth=3, max_leaves=max_leaves)

    def walk(tree, row):
        node = tree[0]
        while node.feature >= 0:
            x = row[node.feature]
            node = tree[node.left if (node.missing_left if x is None else x <= node.edge) else node.right]
        return node.value

    rows = bo.with_prediction(df, model).collect()
    for r in rows[:200]:
        assert r["prediction"] == pytest.approx(model.base + sum(walk(t, (r["a"], r["b"])) for t in model.trees))
    for tree in model.trees:
        leaves = [n for n in tree if n.feature < 0]
        assert sum(n.rows for n in leaves) == len(y)
        assert max_leaves is None or len(leaves) <= max_leaves
    error = np.mean([(r["prediction"] - r["y"]) ** 2 for r in rows])
    assert error < 0.3 * np.var(y)
    assert sum(model.importance().values()) == pytest.approx(1)


def test_all_values_against_missing(spark):
    df = spark.createDataFrame([(float(i % 3), 0.0) for i in range(30)] + [(None, 9.0)] * 20, "x double, y double")
    model = bo.fit_boosted(df, ["x"], "y", trees=1, depth=1, learning_rate=1.0, penalty=0.0)
    root = model.trees[0][0]
    assert (root.edge, root.missing_left) == (math.inf, False)
    got = {r["x"]: r["p"] for r in df.withColumn("p", model.predict(df)).collect()}
    assert got[None] == pytest.approx(9) and got[2.0] == pytest.approx(0)


def test_logistic(spark):
    df = spark.range(400).select((F.col("id") % 40).cast("double").alias("x"), F.when(F.col("id") % 40 > 25, 1).otherwise(0).alias("y"))
    model = bo.fit_boosted(df, ["x"], "y", objective="logistic", trees=8, depth=2, min_hessian=0.1, max_bins=64)
    wrong = df.withColumn("p", model.predict(df)).where("(p >= 0.5) != (y = 1) or p < 0 or p > 1").count()
    assert wrong == 0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert bo.fit_boosted(empty, ["x"], "y").trees == []
    nans = spark.createDataFrame([(float("nan"), 1.0), (None, 3.0), (5.0, None), (5.0, float("nan"))], "x double, y double")
    model = bo.fit_boosted(nans, ["x"], "y", trees=3)
    assert model.trees == [] and model.base == 2.0
    assert [r["p"] for r in nans.select(model.predict(nans).alias("p")).collect()] == [2.0] * 4


def test_unknown_objective(spark, sample):
    with pytest.raises(ValueError):
        bo.fit_boosted(sample[0], ["a"], "y", objective="huber")
