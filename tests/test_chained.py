"""Chained imputation from cross-products against the same chain over rows, and against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import chained, models as md


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 300
    base = rng.normal(size=(n, 2))
    x = np.column_stack([base[:, 0] * 5 + 100, base @ [1, 2] + rng.normal(size=n) * 0.3, base @ [-2, 1] + 7, rng.normal(size=n)])
    gaps = rng.random((n, 4)) < [0.2, 0.3, 0.15, 0]
    rows = [(i, *[None if g else float(v) for v, g in zip(row, gap)]) for i, (row, gap) in enumerate(zip(x, gaps))]
    return spark.createDataFrame(rows, "k int, a double, b double, c double, d double").repartition(4)


def values(df):
    return np.array([[r[c] for c in "abcd"] for r in df.orderBy("k").collect()], dtype=float)


def brute(rows, rounds, solve, fit=None):
    """The chain over rows in numpy."""
    x, missing = rows.copy(), np.isnan(rows)
    fit = np.ones(len(x), dtype=bool) if fit is None else fit
    for j in range(x.shape[1]):
        x[missing[:, j], j] = rows[fit & ~missing[:, j], j].mean()
    for _ in range(rounds):
        for j in range(x.shape[1]):
            if missing[:, j].any():
                use = fit & ~missing[:, j]
                others = np.delete(x, j, axis=1)
                mx, my = others[use].mean(axis=0), x[use, j].mean()
                w = solve(others[use] - mx, x[use, j] - my)
                x[missing[:, j], j] = (others[missing[:, j]] - mx) @ w + my
    return x


@pytest.mark.parametrize("ridge, solve", [
    (0.0, lambda x, y: np.linalg.lstsq(x, y, rcond=None)[0]),
    (3.0, lambda x, y: np.linalg.solve(x.T @ x + 3.0 * np.eye(x.shape[1]), x.T @ y)),
])
@pytest.mark.parametrize("part", [False, True])
def test_equals_the_chain_over_rows(spark, table, ridge, solve, part):
    given = values(table)
    fit_on = F.col("k") % 3 != 0 if part else None
    got = values(md.mice_impute(table, list("abcd"), rounds=3, tolerance=0.0, fit_on=fit_on, ridge=ridge))
    want = brute(given, 3, solve, np.arange(len(given)) % 3 != 0 if part else None)
    assert np.allclose(got, want, rtol=1e-7, atol=1e-7)
    assert np.array_equal(got[~np.isnan(given)], given[~np.isnan(given)])


def test_equals_the_way_by_rounds(table):
    got = values(md.mice_impute(table, list("abcd"), rounds=2, tolerance=0.0))
    assert np.allclose(got, values(md.mice_by_rounds(table, list("abcd"), rounds=2, tolerance=0.0)), rtol=1e-6)
    assert np.allclose(got, values(md.mice_impute(table, list("abcd"), rounds=2, tolerance=0.0, max_patterns=2)), rtol=1e-6)


def test_evidence_shrinks_noise_and_keeps_signal():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 5))
    x -= x.mean(axis=0)
    strong = x @ [3, 0, 0, 0, 0] + rng.normal(size=80) * 0.1
    noise = rng.normal(size=80)
    for y, check in ((strong, lambda w: abs(w[0] - 3) < 0.1), (noise, lambda w: np.abs(w).sum() < 0.5 * np.abs(np.linalg.lstsq(x, noise, rcond=None)[0]).sum())):
        y = y - y.mean()
        assert check(chained.evidence_slopes(x.T @ x, x.T @ y, y @ y, len(y)))


def test_stops_when_values_settle(table):
    one = values(md.mice_impute(table, list("abcd"), rounds=1, tolerance=0.0))
    assert np.array_equal(values(md.mice_impute(table, list("abcd"), rounds=50, tolerance=1e9)), one)
    assert not np.allclose(values(md.mice_impute(table, list("abcd"), rounds=50, tolerance=1e-3)), one)


def test_columns_that_depend_on_each_other_and_empty_ones(spark):
    rows = [(float(i), 2.0 * i, None if i % 4 == 0 else 3.0 * i, None) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = md.mice_impute(df, ["a", "b", "c", "d"], rounds=2).collect()
    assert all(r["c"] == pytest.approx(3 * r["a"], abs=1e-6) and r["d"] is None for r in out)
    assert md.mice_impute(df.where("false"), ["a", "c"]).count() == 0
