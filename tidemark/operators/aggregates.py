"""Grouped, conditional and windowed aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import nan_to_null
from tidemark.functions.ordering import row_position


def group_sum(df: DataFrame, key: str, amount: str, name: str = "total") -> DataFrame:
    """Sum per key, largest first (ties by key)."""
    return df.groupBy(key).agg(F.sum(amount).alias(name)).orderBy(F.desc(name), key)


def groups_above(df: DataFrame, key: str, amount: str, minimum: float, name: str = "total") -> DataFrame:
    """Sum per key, keeping the keys whose sum exceeds ``minimum``."""
    return df.groupBy(key).agg(F.sum(amount).alias(name)).where(F.col(name) > minimum)


def max_groups(df: DataFrame, key: str, amount: str, digits: int, name: str = "total") -> DataFrame:
    """Every key whose rounded sum equals the largest one."""
    totals = df.groupBy(key).agg(F.round(F.sum(amount), digits).alias(name))
    return totals.where(F.col(name) == totals.agg(F.max(name)).scalar())


def top_rows(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), tie).limit(k)


def conditional_counts(df: DataFrame, rules: Mapping[str, Column], percent: bool = False) -> DataFrame:
    """One row with the number of rows that meet each rule; all rules share one pass."""
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    if not percent:
        return df.agg(*counts)
    shares = [
        F.try_divide(F.count_if(rule) * F.lit(100.0), F.count(F.lit(1))).alias(f"{name}_percent")
        for name, rule in rules.items()
    ]
    return df.agg(*counts, *shares)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` for several columns in one pass, values as text, null kept as a value."""
    return (
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def percent_by_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group counts with their share of all rows; null keys form a group.

    The total is summed from the counts, so both share one scan and one shuffle.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("len"))
    total = counts.agg(F.sum("len").alias("rows")).scalar()
    return counts.withColumn("percent", F.try_divide(F.col("len") * F.lit(100.0), total))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(f"`{c}`")).alias(c) for c in columns])


def transpose_row(row: DataFrame, header: str = "column_name", value: str = "value") -> DataFrame:
    """A one-row frame as ``(column, value)`` rows, values as text."""
    names = row.columns
    return row.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names]).unpivot([], names, header, value)


def first_row(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(order).limit(1)


def rows_at_maximum(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def group_total_on_rows(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """The group's sum on each of its rows: ``sum(amount) over (partition by key)``.

    The sums are aggregated (combined before the shuffle) and joined back, so that a hot key is neither
    sorted nor buffered in one task.
    """
    totals = df.groupBy(key).agg(F.sum(amount).alias(name))
    return null_safe_join(df, totals, [key])


def numbered_rows(df: DataFrame, order: Sequence[str], name: str = "row_num", start: int = 1) -> DataFrame:
    """``row_number() over (order by …)`` over the whole table without a single-task sort."""
    return row_position(df, order, name, start=start)


def crosstab(df: DataFrame, row: str, flag: Column, names: Mapping[bool, str]) -> DataFrame:
    """Counts of a true/false flag per row value; null row values are left out."""
    return (
        df.where(F.col(row).isNotNull())
        .select(row, flag.alias("flag"))
        .groupBy(row)
        .pivot("flag", list(names))
        .count()
        .na.fill(0)
        .withColumnsRenamed({str(k).lower(): v for k, v in names.items()})
    )


def flag_rates(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], drop_null_keys: bool = False) -> DataFrame:
    """Share of rows per group for which each flag holds."""
    source = df.na.drop(subset=list(keys)) if drop_null_keys else df
    return source.groupBy(*keys).agg(*[F.avg(f.cast("int")).alias(n) for n, f in flags.items()])


def missing_by_group(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows, missing rows and missing share per group; null keys are left out."""
    return (
        nan_to_null(df, column).na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(column).isNull()).alias("missing_count"),
            F.avg(F.col(column).isNull().cast("int")).alias("missing_ratio"),
        )
    )


def unique_flagged_values(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Distinct ``(column, value)`` pairs for which that column's flag holds."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"), f.alias("flag"))
            for c, f in flags.items()
        ]
    )
    return (
        df.where(reduce(or_, flags.values()))
        .select(F.explode(cells).alias("cell"))
        .where("cell.flag")
        .select("cell.column", "cell.value")
        .distinct()
    )


def group_mean_ranked(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Group means, largest first; a group without values comes first, as a null sorts before all numbers."""
    return df.groupBy(key).agg(F.avg(value).alias(name)).orderBy(F.desc_nulls_first(name), key)


def top_k_overlap(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, k: int) -> DataFrame:
    """How many of the top ``k`` keys of two rankings agree, and which."""
    a = left.orderBy(F.desc_nulls_first(left_value), key).limit(k).select(key)
    b = right.orderBy(F.desc_nulls_first(right_value), key).limit(k).select(key)
    return a.intersect(b).agg(
        F.count(F.lit(1)).alias("overlap"),
        F.array_join(F.sort_array(F.collect_list(key)), ", ").alias("members"),
    )


def group_rank_join(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Inner join whose clashing right-hand columns get ``suffix``."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c != key and c in left.columns}
    return left.join(right.withColumnsRenamed(clash), on=key, how="inner")
