"""Column profiles: types, null shares, describe/summarise blocks, correlation and shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import is_missing, nan_to_null, null_if_nan, numeric_columns
from tidemark.functions.quantiles import column_quantiles, quantile_rows, quantiles


def schema_table(df: DataFrame) -> DataFrame:
    """``(column, dtype)``, one row per column."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def per_column(df: DataFrame, measures: dict[str, list[tuple[str, Column]]], by: Sequence[str] = ()) -> DataFrame:
    """Aggregate many columns in one pass and return one row per column (and group).

    ``measures`` maps a column name to its list of ``(measure name, aggregate)``.
    """
    cells = [
        F.struct(F.lit(name).alias("column"), *[agg.alias(m) for m, agg in parts]).alias(f"c{i}")
        for i, (name, parts) in enumerate(measures.items())
    ]
    wide = df.groupBy(*by).agg(*cells)
    return wide.select(*by, F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cells))])))


def nonnull_percent(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return per_column(
        df,
        {
            c: [
                ("non_null", F.count_if(~is_missing(df, c))),
                ("percent", F.try_divide(F.count_if(~is_missing(df, c)) * F.lit(100.0), rows)),
            ]
            for c in df.columns
        },
    )


def null_report(df: DataFrame, digits: int = 2) -> DataFrame:
    """Columns with missing values: count, share in percent and type, most missing first."""
    rows = F.count(F.lit(1))
    counts = per_column(
        df,
        {
            c: [
                ("null_count", F.count_if(is_missing(df, c))),
                ("null_percent", F.round(F.try_divide(F.count_if(is_missing(df, c)) * F.lit(100.0), rows), digits)),
            ]
            for c in df.columns
        },
    )
    return (
        counts.where("null_count > 0")
        .join(schema_table(df), on="column", how="left")
        .orderBy(F.desc("null_count"), "column")
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """count, null_count, mean, std, min, quartiles and max per column (and per group)."""
    columns, by = list(columns or numeric_columns(df)), list(by)
    keys = [*by, "column"]
    measures = {}
    for c in columns:
        value = null_if_nan(df, c).cast("double")
        measures[c] = [
            ("count", F.count(value)),
            ("null_count", F.count_if(is_missing(df, c))),
            ("mean", F.avg(value)),
            ("std", F.stddev_samp(value)),
            ("min", F.min(value)),
            ("max", F.max(value)),
        ]
    basic = per_column(df, measures, by)
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], by)
    return null_safe_join(basic, quartiles, keys)


def summarize(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """One row per column: type, min, max, approximate distinct count, mean, std, approximate quartiles,
    row count and null percent. Fixed-size sketches only, so that any number of columns fits one pass."""
    numeric = set(numeric_columns(df))
    rows = F.count(F.lit(1))
    measures = {}
    for f in df.schema.fields:
        c = null_if_nan(df, f.name)
        is_number = f.name in numeric
        none = F.lit(None).cast("double")
        sketch = F.percentile_approx(c.cast("double"), [0.25, 0.5, 0.75], 10000) if is_number else None
        measures[f.name] = [
            ("dtype", F.max(F.lit(f.dataType.simpleString()))),
            ("min", F.min(c).cast("string")),
            ("max", F.max(c).cast("string")),
            ("approx_unique", F.approx_count_distinct(c, rsd)),
            ("avg", F.avg(c.cast("double")) if is_number else none),
            ("std", F.stddev_samp(c.cast("double")) if is_number else none),
            *[(f"q{p}", F.get(sketch, F.lit(i)) if is_number else none) for i, p in enumerate((25, 50, 75))],
            ("count", rows),
            ("null_percent", F.try_divide(F.count_if(is_missing(df, f.name)) * F.lit(100.0), rows)),
        ]
    return per_column(df, measures)


def constant_columns(df: DataFrame, max_missing: float = 0.7) -> DataFrame:
    """Per numeric column whether it is constant (nulls ignored), its missing share and whether to keep it.

    A column is constant when its least and largest values agree, so no distinct count is needed.
    """
    measures = {}
    for c in numeric_columns(df):
        value, share = null_if_nan(df, c), F.avg(is_missing(df, c).cast("int"))
        varies = F.coalesce(F.min(value) < F.max(value), F.lit(False))
        measures[c] = [
            ("is_constant", ~varies),
            ("missing_ratio", share),
            ("keep", varies & (share < max_missing)),
        ]
    return per_column(df, measures)


def stat_block(df: DataFrame, value: str, by: Sequence[str] = (), method: str = "linear") -> DataFrame:
    """mean, median, std and 95th percentile."""
    df = nan_to_null(df, value)
    basic = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    marks = quantiles(df, value, [0.5, 0.95], by, ["median", "p95"], method)
    if by:
        return null_safe_join(basic, marks, list(by))
    marked = basic.withColumn("__marks", marks.select(F.struct("median", "p95")).scalar())
    return marked.select("mean", F.col("__marks.median").alias("median"), "std", F.col("__marks.p95").alias("p95"))


def quantile_list(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles at ``probs`` and the maximum, one row per group and probability (1.0 for the maximum)."""
    rows = quantile_rows(df, value, [*probs, 1.0], by)
    labels = F.array(*[F.lit(float(p)) for p in [*probs, 1.0]])
    return rows.select(*by, F.get(labels, F.col("prob_idx")).alias("prob"), "quantile")


def correlation(a: Column, b: Column) -> Column:
    """Pearson over pairs where both are present; null for constant input instead of an error."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), spread)


def pair_corr(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    df = nan_to_null(df, *[c for pair in pairs for c in pair])
    return df.agg(*[correlation(F.col(a), F.col(b)).alias(f"{a}__{b}") for a, b in pairs])


def shape_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis per column."""
    return per_column(
        nan_to_null(df, *columns), {c: [("skewness", F.skewness(c)), ("kurtosis", F.kurtosis(c))] for c in columns}
    )
