import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import missing as ms
from tidemark.operators import models as md
from tidemark.operators import outliers as ou
from tidemark.operators import profile as pf
from tidemark.operators.impute import simple_imputations


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3))
    x[:, 1] += 0.7 * x[:, 0]
    x[rng.random(400) < 0.2, 1] = np.nan
    x[rng.random(400) < 0.1, 2] = np.nan
    return pd.DataFrame(x, columns=["a", "b", "c"])


def test_null_report_counts_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, "x")], "n double, s string")
    got = {r["column"]: (r["null_count"], r["null_percent"], r["dtype"]) for r in pf.null_report(df).collect()}
    assert got == {"n": (1, 33.33, "double"), "s": (2, 66.67, "string")}


def test_correlation_of_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(pf.correlation(F.col("a"), F.col("b"))).first()[0] is None


def test_little_statistic_against_numpy(spark, numbers):
    row = ms.little_mcar(spark.createDataFrame(numbers).replace(float("nan"), None), ["a", "b", "c"]).first()
    mean, cov = numbers.mean().values, numbers.cov().values
    statistic, observed = 0.0, 0
    for _, group in numbers.groupby(numbers.notna().apply(tuple, axis=1)):
        seen = np.flatnonzero(group.notna().iloc[0].values)
        delta = group.iloc[:, seen].mean().values - mean[seen]
        statistic += len(group) * delta @ np.linalg.solve(cov[np.ix_(seen, seen)], delta)
        observed += len(seen)
    assert row["statistic"] == pytest.approx(statistic)
    assert row["dof"] == observed - 3
    assert 0.0 <= row["p_value"] <= 1.0


def test_chi_square_tail_known_values():
    assert ms.chi_square_tail(2 * math.log(20), 2) == pytest.approx(0.05)
    assert ms.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert ms.chi_square_tail(50.0, 3) == pytest.approx(7.98e-11, rel=1e-2)


def test_auc_counts_ties_half(spark, window_mode):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"s": rng.integers(0, 20, 300), "y": rng.integers(0, 2, 300)})
    pos, neg = pdf.loc[pdf.y == 1, "s"].values, pdf.loc[pdf.y == 0, "s"].values
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert ms.auc_by_ranks(spark.createDataFrame(pdf), "s", "y").first()["auc"] == pytest.approx(want)


def test_missing_depends_on_other_column(spark):
    df = spark.range(2000).select(
        F.col("id").cast("double").alias("x"), F.when(F.col("id") < 1000, F.lit(1.0)).alias("t")
    )
    assert ms.missing_auc(df, "t", ["x"]).first()["auc"] > 0.99


def test_pairs_of_a_wide_table(spark):
    rng = np.random.default_rng(3)
    cells = rng.normal(size=(200, 30))
    cells[rng.random(cells.shape) < 0.15] = np.nan
    names = [f"c{i}" for i in range(30)]
    pdf = pd.DataFrame(cells, columns=names).assign(full=1.0, empty=np.nan)
    df, names = spark.createDataFrame(pdf), [*names, "full", "empty"]
    gone = pdf.isna().astype(float)
    want = {(a, b): gone[a].corr(gone[b]) for k, a in enumerate(names) for b in names[k + 1 :]}
    got = {(r["a"], r["b"]): r["r"] for r in ms.nullity_corr(df, names).collect()}
    assert got == pytest.approx({k: v for k, v in want.items() if not np.isnan(v)})
    far = {(r["a"], r["b"]): r["distance"] for r in ms.nullity_distance(df, names).collect()}
    assert far == pytest.approx({(a, b): np.sqrt((gone[a] != gone[b]).sum()) for a, b in want})
    r = {(r["value_column"], r["missing_column"]): r["r"] for r in ms.value_missing_corr(df, names[:5], names).collect()}
    for (v, m), value in r.items():
        known = pdf[v].notna()
        expected = pdf.loc[known, v].corr(gone.loc[known, m])
        assert value is None if np.isnan(expected) else value == pytest.approx(expected)
    assert len(r) == 5 * len(names) - 5


def test_pairs_of_empty_tables(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert ms.nullity_corr(df, ["a", "b"]).count() == 0
    assert [r["distance"] for r in ms.nullity_distance(df, ["a", "b"]).collect()] == [0.0]
    assert [r["r"] for r in ms.value_missing_corr(df, ["a"], ["b"]).collect()] == [None]
    assert ms.nullity_distance(df, ["a"]).count() == 0


def test_mice_recovers_a_linear_column(spark):
    df = spark.range(500).select(
        (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("z")
    ).withColumn("y", F.when(F.col("x") < 14, 3 * F.col("x") - 2 * F.col("z") + 1))
    out = md.mice_impute(df, ["x", "y", "z"], rounds=5)
    assert out.columns == ["x", "z", "y"]
    error = out.agg(F.max(F.abs(F.col("y") - (3 * F.col("x") - 2 * F.col("z") + 1)))).first()[0]
    assert error < 1e-6


def test_simple_imputation_variants(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,), (None,)], "x double")
    got = {r["variant"]: r["n"] for r in simple_imputations(df, "x").groupBy("variant").agg(F.sum("value").alias("n")).collect()}
    assert got == {"observed": 107.0, "mean": 107.0 + 26.75, "median": 110.0}


def test_histogram_closes_last_bin_and_constant_column(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    got = {r["bin"]: r["count"] for r in ou.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r["count"] for r in ou.histogram(flat, "x", 5).collect()] == [2]


def test_binned_counts_close_on_the_right(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    got = {r["bin"]: r["count"] for r in ou.binned_counts(df, "x", 5).collect()}
    assert got == {1: 3, 2: 2, 3: 2, 4: 2, 5: 2}


def test_range_bounds(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (45.0,), (46.0,), (None,)], "x double")
    opened = [r["x"] for r in ou.range_to_null(df, "x", 0, 45).collect()]
    closed = [r["x"] for r in ou.range_to_null(df, "x", 0, 45, upper_inclusive=True).collect()]
    assert (opened, closed) == ([None, 10.0, None, None, None], [None, 10.0, 45.0, None, None])


def test_ks_accepts_normal_sample(spark):
    from statistics import NormalDist

    rows = [(NormalDist().inv_cdf((i + 0.5) / 500),) for i in range(500)]
    assert ou.ks_test(spark.createDataFrame(rows, "x double"), "x").first()["p_value"] > 0.9


def test_k2_published_example(spark):
    rng = np.random.default_rng(0)
    normal = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=2000)}))
    skewed = spark.createDataFrame(pd.DataFrame({"x": rng.exponential(size=2000)}))
    assert ou.dagostino_k2(normal, "x").first()["p_value"] > 0.01
    assert ou.dagostino_k2(skewed, "x").first()["p_value"] < 1e-6


def test_scatter_sample_is_repeatable(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    first = {r["id"] for r in ms.scatter_sample(df, "id", ["id", "x"], 0.1).collect()}
    again = {r["id"] for r in ms.scatter_sample(df.repartition(7), "id", ["id", "x"], 0.1).collect()}
    assert first == again and 350 < len(first) < 650


def test_model_grid_scores_every_pair(spark):
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 7 != 0, (F.col("id") % 13).cast("double")).alias("a"), (F.col("id") % 5).cast("double").alias("b"),
    ).withColumn("y", F.coalesce("a", F.lit(6.0)) * 2 + F.col("b"))
    rows = md.impute_model_grid(df, "y", "id", rounds=2, models=["linear"]).collect()
    assert {(r["imputer"], r["model"]) for r in rows} == {(i, "linear") for i in md.IMPUTERS}
    assert all(r["r2"] > 0.9 for r in rows)


def test_summarize_small_frame(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (float("nan"), None), (4.0, "a")], "x double, s string")
    got = {r["column"]: r for r in pf.summarize(df).collect()}
    x, s = got["x"], got["s"]
    assert (x["dtype"], x["min"], x["max"], x["approx_unique"], x["q50"], x["count"], x["null_percent"]) == (
        "double", "1.0", "4.0", 3, 2.0, 4, 25.0)
    assert (s["min"], s["max"], s["approx_unique"], s["avg"], s["q50"], s["null_percent"]) == ("a", "b", 2, None, None, 25.0)


def test_little_with_columns_that_depend_on_each_other(spark):
    rows = [(float(i % 7), 2.0 * (i % 7), None if i % 3 == 0 else float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    both, one = (md_row(df, names) for names in (["a", "b", "c"], ["a", "c"]))
    assert both["statistic"] == pytest.approx(one["statistic"], rel=1e-6)


def md_row(df, names):
    from tidemark.operators.missing import little_mcar

    return little_mcar(df, names).first()
