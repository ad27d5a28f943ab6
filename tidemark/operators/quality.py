"""Validation logs, duplicate marks and dimension/fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.ordering import row_position


def validation_log(df: DataFrame, key: str, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One row per violated rule: key, rule, column and the offending value as text.

    ``rules`` maps a rule name to (column, condition that marks it bad).
    """
    hits = [
        F.when(bad, F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for rule, (c, bad) in rules.items()
    ]
    return df.select(key, F.explode(F.array_compact(F.array(*hits))).alias("hit")).select(key, "hit.*")


def mark_duplicates(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keep all rows; add the number of copies and whether the row is a repeat of an earlier key.

    Copies are counted by a digest of the compared columns with a map-side combine, and only groups with
    more than one member are joined back, so a text that makes up much of the table stays cheap.
    """
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    tagged = df.withColumn("__digest", digest)
    groups = (
        tagged.groupBy("__digest")
        .agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__first"))
        .where("__n > 1")
    )
    joined = null_safe_join(tagged, groups, ["__digest"])
    return joined.select(
        *df.columns,
        F.coalesce(F.col("__n"), F.lit(1)).alias("copies"),
        F.coalesce(F.col(key) != F.col("__first"), F.lit(False)).alias("is_repeat"),
    )


def dimension(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct attribute rows with a surrogate key numbered in attribute order."""
    return row_position(df.select(*columns).distinct(), list(columns), key)


def star_model(df: DataFrame, dimensions: Mapping[str, Sequence[str]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Split a flat table into dimensions and a fact table that refers to them by surrogate key."""
    fact, dims = df, {}
    for key, columns in dimensions.items():
        dims[key] = dimension(df, columns, key)
        fact = null_safe_join(fact, dims[key], list(columns)).drop(*columns)
    return fact, dims
