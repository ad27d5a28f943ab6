"""Filling gaps by group statistics, and judging what the filling did to the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import nan_to_null
from tidemark.functions.quantiles import quantiles
from tidemark.functions.scalars import relative_change_percent
from tidemark.operators.profile import stat_block
from tidemark.session import pin_measured


def group_median_on_rows(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """``median(value) over (partition by …)`` as an aggregate joined back; null keys form a group."""
    return null_safe_join(df, quantiles(df, value, [0.5], by, [name]), list(by))


def grouping_medians(df: DataFrame, value: str, groupings: Sequence[Sequence[str]]) -> tuple[DataFrame, int]:
    """Medians of several groupings in one pass, ``(__set, *key columns, __median)``, and their size in bytes.

    Like grouping sets, each row feeds one cell per grouping, with the unused key columns null; cells are
    combined before the shuffle. The empty grouping is the overall median.
    """
    keys = sorted({c for by in groupings for c in by})
    sets = [
        F.struct(F.lit(i).alias("__set"), *[(F.col(k) if k in by else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys])
        for i, by in enumerate(groupings)
    ]
    tall = df.select(F.col(value).alias("__value"), F.explode(F.array(*sets)).alias("s")).select("__value", "s.*")
    pinned, _, size = pin_measured(quantiles(tall, "__value", [0.5], ["__set", *keys], ["__median"]))
    return pinned, size


def impute_group_median(df: DataFrame, value: str, by: Sequence[str], into: str | None = None) -> DataFrame:
    """Gaps become the group's median, or the overall median where the group has no value at all."""
    df = nan_to_null(df, value)
    medians, size = grouping_medians(df, value, [list(by), []])
    overall = medians.where("__set = 1").agg(F.max("__median")).scalar()
    filled = null_safe_join(df, medians.where("__set = 0").drop("__set"), list(by), size=size)
    return filled.withColumn(into or value, F.coalesce(F.col(value), F.col("__median"), overall)).drop("__median")


def drop_missing(df: DataFrame, value: str) -> DataFrame:
    return nan_to_null(df, value).where(F.col(value).isNotNull())


def both_variants(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """``(variant, value)``: the column after dropping gaps and after imputing them."""
    filled = impute_group_median(nan_to_null(df, value), value, by, "__filled")
    tall = filled.select(
        F.inline(
            F.array(
                F.struct(F.lit("drop").alias("variant"), F.col(value).alias("value")),
                F.struct(F.lit("impute").alias("variant"), F.col("__filled").alias("value")),
            )
        )
    )
    return drop_missing(tall, "value")


def drop_vs_impute(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """mean, median, std and p95 after dropping and after imputing, side by side with their change in percent."""
    names = ["mean", "median", "std", "p95"]
    blocks = stat_block(both_variants(df, value, by), "value", ["variant"])
    side_by_side = blocks.agg(
        *[F.max(F.when(F.col("variant") == "drop", F.col(n))).alias(n) for n in names],
        *[F.max(F.when(F.col("variant") == "impute", F.col(n))).alias(f"{n}_impute") for n in names],
    )
    return side_by_side.select(
        "*",
        *[relative_change_percent(F.col(n), F.col(f"{n}_impute")).alias(f"{n}_change_percent") for n in names],
    )


def compare_groupings(df: DataFrame, value: str, groupings: Sequence[Sequence[str]], masked: Column) -> DataFrame:
    """Hide known values where ``masked`` holds, impute them per grouping from the rest, score against the truth.

    ``fallback_rate`` is the share of hidden rows whose group had no visible value. All groupings share one
    pass over the table.
    """
    known = drop_missing(df, value).withColumn("__masked", masked)
    medians, size = grouping_medians(known.where(~F.col("__masked")), value, [*groupings, []])
    overall = medians.where(F.col("__set") == len(groupings)).agg(F.max("__median")).scalar()
    keys = [c for c in medians.columns if c not in ("__set", "__median")]
    sets = [
        F.struct(F.lit(i).alias("__set"), *[(F.col(k) if k in by else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys])
        for i, by in enumerate(groupings)
    ]
    hidden = known.where("__masked").select(F.col(value).alias("__truth"), F.explode(F.array(*sets)).alias("s"))
    guessed = null_safe_join(hidden.select("__truth", "s.*"), medians, ["__set", *keys], size=size)
    error = F.coalesce(F.col("__median"), overall) - F.col("__truth")
    names = F.array(*[F.lit(", ".join(by)) for by in groupings])
    return (
        guessed.select("__set", "__median", error.alias("e"))
        .groupBy("__set")
        .agg(
            F.avg(F.abs("e")).alias("mae"),
            F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
            F.avg(F.col("__median").isNull().cast("int")).alias("fallback_rate"),
        )
        .select(F.get(names, F.col("__set")).alias("grouping"), "mae", "rmse", "fallback_rate")
    )


def mask_and_score(df: DataFrame, value: str, by: Sequence[str], masked: Column) -> DataFrame:
    """The hold-out score of one grouping."""
    return compare_groupings(df, value, [by], masked)


def simple_imputations(df: DataFrame, value: str) -> DataFrame:
    """``(variant, value)``: observed values only, and gaps filled by the mean and by the median."""
    df = nan_to_null(df, value)
    mean = df.agg(F.avg(value).alias("m")).scalar()
    median = quantiles(df, value, [0.5], names=["m"]).scalar()
    variants = df.select(
        F.col(value).cast("double").alias("observed"),
        F.coalesce(F.col(value).cast("double"), mean).alias("mean"),
        F.coalesce(F.col(value).cast("double"), median).alias("median"),
    ).unpivot([], ["observed", "mean", "median"], "variant", "value")
    return variants.where(F.col("value").isNotNull())


def sensitivity(df: DataFrame, value: str, by: Sequence[str], factors: Mapping[str, float]) -> DataFrame:
    """Statistics of the column when imputed values are scaled, or replaced by the worst or best known value."""
    df, known = nan_to_null(df, value), F.col(value)
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    imputed = impute_group_median(df, value, by, "__filled").withColumn("__ends", ends)
    scenarios = [
        F.struct(F.lit(n).alias("scenario"), F.coalesce(known, F.col("__filled") * F.lit(f)).alias("value"))
        for n, f in factors.items()
    ]
    scenarios += [
        F.struct(F.lit("lowest").alias("scenario"), F.coalesce(known, F.col("__ends.low")).alias("value")),
        F.struct(F.lit("highest").alias("scenario"), F.coalesce(known, F.col("__ends.high")).alias("value")),
    ]
    tall = imputed.select(F.inline(F.array(*scenarios)))
    return stat_block(tall, "value", ["scenario"])
