"""Scoring imputation by how well models predict from the imputed columns: least squares, forests and Spark's boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import nan_to_null, null_if_nan
from tidemark.functions.quantiles import column_quantiles
from tidemark.operators import boosting, chained, forests
from tidemark.operators.outliers import histogram
from tidemark.operators.profile import constant_columns, per_column
from tidemark.session import pin, pin_columns, pin_for_reuse

MODELS = ("linear", "forest", "boosting")
FOREST_TREES, FOREST_DEPTH = 20, 6
FINE_BINS = 256  # cells for Spark's trees, which choose at most 31 cuts among their edges
IMPUTERS = ("mean", "median", "mice")


def modelling_columns(df: DataFrame, target: str, max_missing: float = 0.7) -> list[str]:
    """Numeric feature names that vary and are not mostly missing, over rows with a target."""
    rows = constant_columns(df.where(F.col(target).isNotNull()), max_missing).where("keep").collect()
    return [r["column"] for r in rows if r["column"] != target]


def modelling_frame(df: DataFrame, target: str, keep: Sequence[str] = (), max_missing: float = 0.7) -> DataFrame:
    """Rows with a target, usable numeric features only."""
    features = [c for c in modelling_columns(df, target, max_missing) if c not in keep]
    return df.where(F.col(target).isNotNull()).select(
        *keep, *[null_if_nan(df, f).cast("double").alias(f) for f in features], F.col(target).cast("double").alias(target)
    )


def is_test(key: Column, fold: int = 5) -> Column:
    """Every ``fold``-th key is held out; the split does not depend on partitioning."""
    return F.pmod(key, F.lit(fold)) == 0


def column_fill(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, float]:
    """Mean or exact median per column, one value each."""
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    rows = column_quantiles(df, columns, [0.5], ["median"]).collect()
    return {r["column"]: r["median"] for r in rows}


def fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if v is not None})


def mice_impute(
    df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3, fit_on: Column | None = None, ridge: float | str = 0.0,
    max_patterns: int = chained.MAX_PATTERNS,
) -> DataFrame:
    """Fill gaps by regressing each column with gaps on all the others, round after round.

    Starts from column means and stops when the change of the filled values falls below ``tolerance`` standard deviations in every column.
    ``fit_on`` limits the rows models are fitted on. All rounds run on cross-products per pattern of missing columns, gathered in one scan;
    tables of more than ``max_patterns`` patterns go round by round over their rows (``mice_by_rounds``, without a penalty).
    """
    columns = list(columns)
    df = nan_to_null(df, *columns)
    known = df if fit_on is None else df.where(fit_on)
    facts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if facts[c]]
    if not gaps:
        return df
    if df.select(chained.pattern_of(columns).alias("p")).distinct().limit(max_patterns + 1).count() > max_patterns:
        if ridge:
            raise ValueError(f"a penalty needs at most {max_patterns} patterns of missing columns")
        return mice_by_rounds(df, columns, rounds, tolerance, fit_on)
    row = known.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns]).first()
    empty = [c for c in columns if row[c]["m"] is None]
    used = [c for c in columns if c not in empty]  # a column without any value has nothing to learn from and stays empty
    means, spread = [row[c]["m"] for c in used], [row[c]["s"] for c in used]
    return chained.chained_fill(df, used, means, spread, [c for c in gaps if c in used], rounds, tolerance, fit_on, ridge)


def mice_by_rounds(
    df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3, fit_on: Column | None = None
) -> DataFrame:
    """The chain over the rows themselves: one fit per column and round, for tables of very many patterns of missing columns.

    Every round is written to the shared folder, so the plan stays one round long and a lost executor costs at most one round. The change
    is measured as the mean absolute one.
    """
    columns = list(columns)
    df = nan_to_null(df, *columns)
    known = df if fit_on is None else df.where(fit_on)
    facts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    spread = known.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    gaps = [c for c in columns if facts[c]]
    if not gaps:
        return df
    flagged = df.withColumns({f"__gap_{c}": F.col(c).isNull() for c in gaps})
    current = pin_for_reuse(fill(flagged, column_fill(known, columns, "mean")))
    for _ in range(rounds):
        step = current.withColumns({f"__old_{c}": F.col(c) for c in gaps})
        for c in gaps:
            others = [o for o in columns if o != c]
            assembler = VectorAssembler(inputCols=others, outputCol="__x")
            rows = step.where(~F.col(f"__gap_{c}"))
            fit_rows = rows if fit_on is None else rows.where(fit_on)
            line = LinearRegression(featuresCol="__x", labelCol=c, predictionCol="__p", solver="normal").fit(
                assembler.transform(fit_rows).select("__x", c)
            )
            # the fitted line as a column expression keeps the update inside generated code
            guess = reduce(
                lambda a, b: a + b, [F.col(o) * F.lit(float(w)) for o, w in zip(others, line.coefficients)], F.lit(float(line.intercept))
            )
            step = step.withColumn(c, F.when(F.col(f"__gap_{c}"), guess).otherwise(F.col(c)))
        step = pin(step)
        moved = step.agg(
            *[F.avg(F.when(F.col(f"__gap_{c}"), F.abs(F.col(c) - F.col(f"__old_{c}")))).alias(c) for c in gaps]
        ).first()
        current = step.drop(*[f"__old_{c}" for c in gaps])
        if all((moved[c] or 0.0) <= tolerance * (spread[c] or 1.0) for c in gaps):
            break
    return current.drop(*[f"__gap_{c}" for c in gaps])


def impute_features(df: DataFrame, features: Sequence[str], strategy: str, fit_on: Column, rounds: int = 10) -> DataFrame:
    """Gaps in the features filled by what the rows selected by ``fit_on`` teach."""
    if strategy == "mice":
        return mice_impute(df, features, rounds, fit_on=fit_on)
    return fill(df, column_fill(df.where(fit_on), features, strategy))


@dataclass
class BinnedModel:
    """A model fitted on numbers of bins; ``transform`` takes the bins of the features first."""

    features: list[str]
    edges: list[list[float]]
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"__b{i}" for i in range(len(self.features))]
        numbers = {b: bin_or_null(null_if_nan(df, c).cast("double"), e) for b, c, e in zip(names, self.features, self.edges)}
        return self.model.transform(df.withColumns(numbers)).drop(*names)


def bin_or_null(value: Column, edges: Sequence[float]) -> Column:
    return F.when(value.isNotNull(), boosting.bin_number(value, edges)).cast("double")


def fit_boosting(binned: boosting.Binned) -> BinnedModel:
    """Spark's boosted trees on cells of rows with equal bins, weighted by their rows.

    Spark's trees cut at bins as well. On squares the best cuts and the values of leaves follow from the rows and mean of each cell, so
    the trees are those of the rows.
    """
    names = [f"__b{i}" for i in range(len(binned.features))]
    rows = binned.cells.select("n", "target", *[F.nullif(f"b{i}", F.lit(0)).cast("double").alias(b) for i, b in enumerate(names)])
    stages = [VectorAssembler(inputCols=names, outputCol="features"), GBTRegressor(maxIter=10, maxDepth=4, seed=42).setLabelCol("target").setWeightCol("n").setPredictionCol("prediction")]
    return BinnedModel(binned.features, binned.edges, Pipeline(stages=stages).fit(rows))


def fit_model(
    df: DataFrame, features: Sequence[str], target: str, model: str, binned: boosting.Binned | None = None
) -> LinearModel | BinnedModel | forests.Forest:
    """A fitted model; ``binned`` hands over the cells of ``df`` where several models of trees share them (with draws, for a forest)."""
    if model == "boosting":
        return fit_boosting(binned or boosting.binned_cells(df, features, target, FINE_BINS))
    if model == "forest":
        return forests.fit_forest(binned or forests.bagged_cells(df, features, target, FOREST_TREES), FOREST_DEPTH)
    if model == "linear":
        return fit_linear(df, features, target)
    raise ValueError(f"unknown model: {model}")


@dataclass
class LinearModel:
    features: list[str]
    weights: list[float]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = [forests.present(df, c) * F.lit(w) for c, w in zip(self.features, self.weights)]
        return df.withColumn("prediction", reduce(lambda a, b: a + b, terms, F.lit(self.intercept)))


def fit_linear(df: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Least squares from the cross-products of one pass. Its predictions do not depend on the scale of the features."""
    columns = [*features, target]
    rows = df.where(null_if_nan(df, target).isNotNull()).select(*[forests.present(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    means = list(rows.agg(*[F.avg(c) for c in rows.columns]).first())
    if means[-1] is None:
        raise ValueError("no rows to learn from")
    weights = chained.regression(sum(chained.cross_products(rows, rows.columns, means, None).values()), len(columns), 0.0)
    slopes = [float(w) for w in weights[1:-1]]
    return LinearModel(list(features), slopes, float(weights[0] + means[-1] - sum(w * m for w, m in zip(slopes, means))))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 in one pass."""
    error = F.col(actual) - F.col(predicted)
    squares = F.sum(error * error)
    spread = F.var_pop(actual) * F.count(actual)
    df = nan_to_null(df, actual, predicted)
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
    )


def impute_model_grid(
    df: DataFrame, target: str, key: str, imputers: Sequence[str] = IMPUTERS, models: Sequence[str] = MODELS, rounds: int = 5
) -> DataFrame:
    """MAE, RMSE and R2 on held-out rows for every imputer and model."""
    frame = modelling_frame(pin_columns(df), target, [key])
    features = [c for c in frame.columns if c not in (key, target)]
    test = is_test(F.col(key))
    scores = []
    for imputer in imputers:
        filled = impute_features(frame, features, imputer, ~test, rounds)
        if imputer == "mice":  # others are one expression a column
            filled = pin_columns(filled)
        train, held_out = filled.where(~test), filled.where(test)
        binned = forests.bagged_cells(train, features, target, FOREST_TREES) if "forest" in models else None  # boosting reads the same cells
        for model in models:
            fitted = fit_model(train, features, target, model, binned)
            metrics = regression_metrics(fitted.transform(held_out), target, "prediction")
            scores.append(metrics.select(F.lit(imputer).alias("imputer"), F.lit(model).alias("model"), "mae", "rmse", "r2"))
    return reduce(lambda a, b: a.unionByName(b), scores)


def predict_missing(df: DataFrame, target: str, features: Sequence[str], model: str = "linear", write_back: bool = False) -> DataFrame:
    """Rows without a target with a prediction for it; with ``write_back`` all rows, gaps filled."""
    fitted = fit_model(df.where(F.col(target).isNotNull()), features, target, model)
    if write_back:
        return fitted.transform(df).withColumn(target, F.coalesce(F.col(target), F.col("prediction"))).select(*df.columns)
    return fitted.transform(df.where(F.col(target).isNull())).select(*df.columns, "prediction")


def prediction_shift(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mean and median of two predictions and of their difference."""
    both = df.select(F.col(a).alias("a"), F.col(b).alias("b"), (F.col(b) - F.col(a)).alias("difference"))
    means = per_column(both, {c: [("mean", F.avg(c))] for c in both.columns})
    return null_safe_join(means, column_quantiles(both, both.columns, [0.5], ["median"]), ["column"])


def residual_rows(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.withColumns({"residual": error, "abs_error": F.abs(error)})


def residual_top(df: DataFrame, actual: str, predicted: str, k: int, tie: Sequence[str]) -> DataFrame:
    return residual_rows(df, actual, predicted).orderBy(F.desc("abs_error"), *tie).limit(k)


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 50) -> DataFrame:
    return histogram(residual_rows(df, actual, predicted), "residual", bins)
