"""Models fitted on cells of rows with equal bins: sums, draws, trees against rows, and the number of rows the steps go over."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tidemark.operators import boosting as bo, forests as fo, models as md


@pytest.fixture(scope="module")
def table(spark):
    """4,000 rows of few values, so that bins are values and Spark's own trees have the same cuts."""
    a, b = F.col("id") % 9, F.floor(F.col("id") / 9) % 7
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 500.0
    frame = spark.range(4000).select("id", a.cast("double").alias("a"), b.cast("double").alias("b"), (F.col("id") % 2).cast("double").alias("c"))
    return frame.withColumn("y", F.col("a") * 3 + F.when(F.col("b") > 3, 10).otherwise(0) + noise).repartition(6)


def assembled(df, names):
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def test_boosting_goes_over_cells(table):
    names = ["a", "b", "c"]
    binned = bo.binned_cells(table, names, "y")
    assert binned.cells.count() <= 9 * 7 * 2
    assert binned.cells.agg(F.sum("n")).first()[0] == 4000
    alone, shared = bo.fit_boosted(table, names, "y", trees=3), bo.fit_boosted(table, names, "y", trees=3, binned=binned)
    assert [[(n.feature, n.cut, n.rows) for n in t] for t in alone.trees] == [[(n.feature, n.cut, n.rows) for n in t] for t in shared.trees]


def test_sparks_boosting_on_cells_is_that_on_rows(table):
    names = ["a", "b", "c"]
    rows = assembled(table, names)
    on_rows = GBTRegressor(maxIter=10, maxDepth=4, seed=42, labelCol="y").fit(rows).transform(rows).select("id", F.col("prediction").alias("p"))
    on_cells = md.fit_model(table, names, "y", "boosting").transform(table).select("id", "prediction")
    assert on_rows.join(on_cells, "id").agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9


def test_linear_equals_sparks(table):
    names = ["a", "b", "c"]
    rows = assembled(table, names)
    theirs = LinearRegression(labelCol="y").fit(rows)
    own = md.fit_model(table, names, "y", "linear")
    assert own.weights == pytest.approx(list(theirs.coefficients)) and own.intercept == pytest.approx(theirs.intercept)


def test_forest_on_cells(table):
    names = ["a", "b", "c"]
    binned = fo.bagged_cells(table, names, "y", trees=20)
    assert binned.cells.count() < 1000
    sums = binned.cells.agg(F.sum("n"), F.sum(F.col("n") * F.col("target")), *[F.sum(F.get("w", F.lit(t))) for t in range(20)]).first()
    assert sums[0] == 4000 and sums[1] == pytest.approx(table.agg(F.sum("y")).first()[0])
    assert all(3500 < w < 4500 for w in sums[2:]) and len(set(sums[2:])) > 10
    forest = fo.fit_forest(binned, 6)
    assert (forest.feature >= 0).sum(axis=1).mean() > 10
    rows = assembled(table, names)
    theirs = RandomForestRegressor(numTrees=20, maxDepth=6, seed=42, labelCol="y").fit(rows).transform(rows)
    error = lambda df: df.agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert error(forest.transform(table)) < 1.5 * error(theirs) + 0.5


def test_one_full_tree_of_a_forest_by_hand():
    feature, cut = np.array([1, -1, 0, -1, -1, -1, -1]), np.array([2, 0, 5, 0, 0, 0, 0])
    x = np.array([[9, 2], [5, 3], [6, 3]])
    assert fo.nodes_of(feature, cut, x).tolist() == [1, 5, 6]


def test_bins_of_values(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (7.0,), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(bo.bin_number(F.col("x"), [1.0, 2.0])).collect()] == [1, 2, 2, 3, 3, 1, 0]


@pytest.mark.parametrize("model", md.MODELS)
def test_a_gap_in_a_feature_is_an_error(spark, model):
    df = spark.createDataFrame([(float(i % 5) if i else None, float(i)) for i in range(40)], "x double, y double")
    with pytest.raises(Exception, match="(?i)missing|null"):
        md.fit_model(df, ["x"], "y", model).transform(df).collect()


def test_sparks_trees_choose_among_finer_cuts(spark):
    df = spark.range(3000).select((F.col("id") % 50).cast("double").alias("x")).withColumn("y", F.when(F.col("x") > 25, 9.0).otherwise(0.0))
    assert len(md.fit_model(df, ["x"], "y", "boosting").edges[0]) == 49
