"""Ranges, thresholds, histograms, outlier flags and normality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import nan_to_null
from tidemark.functions.quantiles import quantile_rows, quantiles
from tidemark.operators.aggregates import percent_by_group
from tidemark.operators.profile import describe


def out_of_range(value: Column, low: float | None, high: float | None, low_inclusive: bool, upper_inclusive: bool) -> Column:
    tests = []
    if low is not None:
        tests.append(value < low if low_inclusive else value <= low)
    if high is not None:
        tests.append(value > high if upper_inclusive else value >= high)
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def range_to_null(
    df: DataFrame, column: str, low: float | None = 0, high: float | None = None,
    low_inclusive: bool = False, upper_inclusive: bool = False, into: str | None = None,
) -> DataFrame:
    """Values outside the range become null; the bounds belong to the range only when marked inclusive."""
    bad = out_of_range(F.col(column), low, high, low_inclusive, upper_inclusive)
    return df.withColumn(into or column, F.when(bad, F.lit(None)).otherwise(F.col(column)))


def out_of_range_counts(df: DataFrame, value: Column, low: float, high: float) -> DataFrame:
    """Rows per value outside ``[low, high]``, with their share of all rows."""
    counts = df.select(value.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("n")).scalar()
    outside = counts.where(~F.col("value").between(low, high))
    return outside.withColumn("percent", F.col("count") * F.lit(100.0) / total)


def threshold_sweep(df: DataFrame, column: str, thresholds: Sequence[float]) -> DataFrame:
    """Describe the column with values above each threshold nulled (and without threshold), in one pass."""
    df, value = nan_to_null(df, column), F.col(column).cast("double")
    variants = [F.struct(F.lit("none").alias("threshold"), value.alias("value"), F.lit(False).alias("above"))]
    variants += [
        F.struct(F.lit(str(t)).alias("threshold"), F.when(value <= t, value).alias("value"), (value > t).alias("above"))
        for t in thresholds
    ]
    tall = df.select(F.inline(F.array(*variants)))
    above = tall.groupBy("threshold").agg(F.count_if("above").alias("n_above"))
    described = describe(tall.select("threshold", F.col("value").alias(column)), [column], ["threshold"])
    return null_safe_join(described.drop("column"), above, ["threshold"], bounded=True)


def value_frequency(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Frequency of each value in ``(low, high]`` with its share of these rows."""
    inside = df.where((F.col(column) > low) & (F.col(column) <= high)).select(column)
    return percent_by_group(inside, [column])


def validity_split(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Row counts for valid, invalid and unknown (null) values of ``(low, high]``."""
    valid = (F.col(column) > low) & (F.col(column) <= high)
    return nan_to_null(df, column).select(valid.alias("is_valid")).groupBy("is_valid").agg(F.count(F.lit(1)).alias("len"))


def outlier_flags(df: DataFrame, column: str, iqr_factor: float = 1.5, z_limit: float = 3.0) -> DataFrame:
    """Add flags by the quartile fences and by the z-score; nulls are never outliers."""
    df = nan_to_null(df, column)
    marks = quantiles(df, column, [0.25, 0.75], names=["q1", "q3"])
    basic = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")).alias("b"))
    value, spread = F.col(column), F.col("__q.q3") - F.col("__q.q1")
    return (
        df.withColumns({"__q": marks.select(F.struct("q1", "q3")).scalar(), "__b": basic.scalar()})
        .withColumns(
            {
                "iqr_outlier": F.coalesce(
                    (value < F.col("__q.q1") - iqr_factor * spread) | (value > F.col("__q.q3") + iqr_factor * spread),
                    F.lit(False),
                ),
                "z_outlier": F.coalesce(
                    F.abs(F.try_divide(value - F.col("__b.mean"), F.col("__b.std"))) > z_limit, F.lit(False)
                ),
            }
        )
        .drop("__q", "__b")
    )


def _span(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    return df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts over the column's range, last bin closed; ``by`` shares one set of bins."""
    df = nan_to_null(df, column)
    spanned = df.where(F.col(column).isNotNull()).withColumn("__s", _span(df, column))
    width = (F.col("__s.hi") - F.col("__s.lo")) / F.lit(bins)
    index = F.least(F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("__s.lo"), width)), F.lit(0)), F.lit(bins - 1))
    return (
        spanned.select(*by, index.cast("int").alias("bin"), F.col("__s.lo").alias("lo"), width.alias("w"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("count"), F.first("lo").alias("lo"), F.first("w").alias("w"))
        .select(*by, "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("left"), "count")
    )


def binned_counts(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width counts with bins closed on the right; the smallest value belongs to the first bin."""
    df = nan_to_null(df, column)
    spanned = df.where(F.col(column).isNotNull()).withColumn("__s", _span(df, column))
    width = (F.col("__s.hi") - F.col("__s.lo")) / F.lit(bins)
    index = F.least(
        F.greatest(F.coalesce(F.ceil(F.try_divide(F.col(column) - F.col("__s.lo"), width)), F.lit(1)), F.lit(1)), F.lit(bins)
    )
    return spanned.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles against standard normal quantiles at evenly spaced probabilities."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    rows = quantile_rows(df, column, probs)
    prob = F.array(*[F.lit(p) for p in probs])
    normal = F.array(*[F.lit(NormalDist().inv_cdf(p)) for p in probs])
    return rows.select(
        F.get(prob, F.col("prob_idx")).alias("prob"),
        F.get(normal, F.col("prob_idx")).alias("theoretical"),
        F.col("quantile").alias("sample"),
    )


def ks_test(df: DataFrame, column: str) -> DataFrame:
    """Kolmogorov-Smirnov test against the normal distribution with the sample's mean and population std."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    present = nan_to_null(df, column).select(F.col(column).cast("double").alias(column)).where(F.col(column).isNotNull())
    fit = present.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")).first()
    return KolmogorovSmirnovTest.test(present, column, "norm", fit["mean"], fit["std"]).select(
        F.col("pValue").alias("p_value"), "statistic"
    )


def dagostino_k2(df: DataFrame, column: str) -> DataFrame:
    """D'Agostino-Pearson omnibus test: z-scores of skewness and kurtosis, their sum of squares and p-value."""
    n, g1 = F.col("n"), F.col("g1")
    moments = nan_to_null(df, column).agg(
        F.count(column).cast("double").alias("n"), F.skewness(column).alias("g1"), (F.kurtosis(column) + 3).alias("b2")
    )
    steps: list[Mapping[str, Column]] = [
        {
            "y": g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2))),
            "beta2": 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)),
            "x": (F.col("b2") - 3 * (n - 1) / (n + 1))
            / F.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))),
            "sb": 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))),
        },
        {
            "w2": F.sqrt(2 * (F.col("beta2") - 1)) - 1,
            "a": 6 + 8 / F.col("sb") * (2 / F.col("sb") + F.sqrt(1 + 4 / (F.col("sb") * F.col("sb")))),
        },
        {
            "t": F.col("y") / F.sqrt(2 / (F.col("w2") - 1)),
            "d": 1 + F.col("x") * F.sqrt(2 / (F.col("a") - 4)),
        },
        {
            "z_skew": F.log(F.col("t") + F.sqrt(F.col("t") * F.col("t") + 1)) / F.sqrt(F.log("w2") / 2),
            "z_kurtosis": (
                1 - 2 / (9 * F.col("a")) - F.signum("d") * F.cbrt((1 - 2 / F.col("a")) / F.abs("d"))
            ) / F.sqrt(2 / (9 * F.col("a"))),
        },
    ]
    out = moments
    for step in steps:
        out = out.withColumns(dict(step))
    k2 = F.col("z_skew") * F.col("z_skew") + F.col("z_kurtosis") * F.col("z_kurtosis")
    return out.select("z_skew", "z_kurtosis", k2.alias("k2"), F.exp(-k2 / 2).alias("p_value"))
