"""Imputation and its evaluation over the table with derived gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import impute as im
from tidemark.operators import profile as pf
from tidemark.operators.outliers import histogram
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded

GROUP = ["p_brand", "p_type"]
FILLED_SQL = (
    "(select d.*, coalesce(d.qty, median(d.qty) over (partition by p_brand, p_type), (select median(qty) from {dn})) "
    "as filled from {dn} d)"
).format(dn=DN_SQL)


def gaps(spark, sf_dir):
    return derived_nulls(spark, sf_dir).select("l_orderkey", "l_quantity", *GROUP, "qty", "price")


@query("drop_rows", f"select count(*) as rows, round(sum(qty), 2) as total from {DN_SQL} where qty is not null")
def drop_rows(spark, sf_dir):
    kept = im.drop_missing(gaps(spark, sf_dir), "qty")
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("qty"), 2).alias("total"))


@query(
    "impute_group_median",
    "select p_brand, p_type, count(*) as rows, round(sum(filled), 2) as total, round(min(filled), 4) as low, "
    f"round(max(filled), 4) as high from {FILLED_SQL} group by all",
)
def impute_group_median(spark, sf_dir):
    filled = im.impute_group_median(gaps(spark, sf_dir), "qty", GROUP)
    return filled.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("qty"), 2).alias("total"),
        F.round(F.min("qty"), 4).alias("low"), F.round(F.max("qty"), 4).alias("high"),
    )


def stat_sql(column: str, source: str) -> str:
    return (
        f"select avg({column}) as mean, median({column}) as median, stddev_samp({column}) as std, "
        f"quantile_cont({column}, 0.95) as p95 from {source}"
    )


STATS = ["mean", "median", "std", "p95"]


@query(
    "drop_vs_impute",
    f"with a as ({stat_sql('qty', DN_SQL)}), b as ({stat_sql('filled', FILLED_SQL)}) select "
    + ", ".join(
        f"round(a.{s}, 6) as {s}, round(b.{s}, 6) as {s}_impute, "
        f"round(abs(b.{s} - a.{s}) / a.{s} * 100, 6) as {s}_change_percent"
        for s in STATS
    )
    + " from a, b",
)
def drop_vs_impute(spark, sf_dir):
    out = im.drop_vs_impute(gaps(spark, sf_dir), "qty", GROUP)
    return rounded(out, 6, *out.columns)


PROBS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95]


@query(
    "impute_quantiles",
    " union all ".join(
        f"select '{variant}' as variant, {p}::double as prob, round(quantile_cont({c}, {p}), 6) as quantile from {source}"
        for variant, c, source in (("drop", "qty", DN_SQL), ("impute", "filled", FILLED_SQL))
        for p in [*PROBS, 1.0]
    ),
)
def impute_quantiles(spark, sf_dir):
    both = im.both_variants(gaps(spark, sf_dir), "qty", GROUP)
    return rounded(pf.quantile_list(both, "value", PROBS, ["variant"]), 6, "quantile")


@query(
    "impute_group_ranking",
    f"with a as (select p_brand, avg(qty) as v from {DN_SQL} where qty is not null group by p_brand), "
    f"b as (select p_brand, avg(filled) as v from {FILLED_SQL} group by p_brand) select p_brand, "
    "round(a.v, 6) as avg_qty, round(b.v, 6) as avg_qty_impute from a join b using (p_brand)",
)
def impute_group_ranking(spark, sf_dir):
    dn = gaps(spark, sf_dir)
    dropped = agg.group_mean_ranked(im.drop_missing(dn, "qty"), "p_brand", "qty", "avg_qty")
    imputed = agg.group_mean_ranked(im.impute_group_median(dn, "qty", GROUP), "p_brand", "qty", "avg_qty")
    return rounded(agg.group_rank_join(dropped, imputed, "p_brand", "_impute"), 6, "avg_qty", "avg_qty_impute")


@query(
    "impute_pair_corr",
    f"select round(corr(price, qty), 6) as drop_corr, round(corr(price, filled), 6) as impute_corr from {FILLED_SQL}",
)
def impute_pair_corr(spark, sf_dir):
    filled = im.impute_group_median(gaps(spark, sf_dir), "qty", GROUP, "filled")
    return filled.agg(
        F.round(pf.correlation(F.col("price"), F.col("qty")), 6).alias("drop_corr"),
        F.round(pf.correlation(F.col("price"), F.col("filled")), 6).alias("impute_corr"),
    )


def score_sql(by: list[str]) -> str:
    keys = ", ".join(by)
    return (
        f"select '{keys}' as grouping, round(avg(abs(coalesce(guess, m) - qty)), 4) as mae, "
        "round(sqrt(avg(power(coalesce(guess, m) - qty, 2))), 4) as rmse, "
        "round(avg((guess is null)::int), 6) as fallback_rate from (select *, "
        f"median(case when l_orderkey % 5 <> 0 then qty end) over (partition by {keys}) as guess, "
        f"(select median(qty) from {DN_SQL} where l_orderkey % 5 <> 0) as m from {DN_SQL} where qty is not null) "
        "where l_orderkey % 5 = 0"
    )


def held_out():
    return F.col("l_orderkey") % 5 == 0


@query("mask_impute_score", score_sql(GROUP))
def mask_impute_score(spark, sf_dir):
    out = im.mask_and_score(gaps(spark, sf_dir), "qty", GROUP, held_out())
    return rounded(rounded(out, 4, "mae", "rmse"), 6, "fallback_rate")


GROUPINGS = [
    ["p_brand"], ["p_brand", "p_type"], ["p_brand", "p_size"], ["p_type"], ["p_type", "p_size"],
    ["p_brand", "p_type", "p_size"],
]


@query("compare_groupings", " union all ".join(f"({score_sql(by)})" for by in GROUPINGS))
def compare_groupings(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir).select("l_orderkey", "p_brand", "p_type", "p_size", "qty")
    out = im.compare_groupings(dn, "qty", GROUPINGS, held_out())
    return rounded(rounded(out, 4, "mae", "rmse"), 6, "fallback_rate")


@query(
    "simple_impute",
    f"with d as (select qty, (select avg(qty) from {DN_SQL}) as m, (select median(qty) from {DN_SQL}) as h from {DN_SQL}), "
    "v as (select 'observed' as variant, qty as x from d where qty is not null union all select 'mean', coalesce(qty, m) "
    "from d union all select 'median', coalesce(qty, h) from d) "
    "select variant, count(*) as rows, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std from v group by variant",
)
def simple_impute(spark, sf_dir):
    variants = im.simple_imputations(gaps(spark, sf_dir), "qty")
    return variants.groupBy("variant").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_samp("value"), 6).alias("std")
    )


@query(
    "impute_histograms",
    f"with d as (select qty, (select avg(qty) from {DN_SQL}) as m, (select median(qty) from {DN_SQL}) as h from {DN_SQL}), "
    "v as (select 'observed' as variant, qty as x from d where qty is not null union all select 'mean', coalesce(qty, m) "
    "from d union all select 'median', coalesce(qty, h) from d), s as (select min(x) as lo, max(x) as hi from v) "
    "select variant, least(cast(floor((x - lo) / ((hi - lo) / 50)) as int), 49) as bin, count(*) as count from v, s group by 1, 2",
)
def impute_histograms(spark, sf_dir):
    return histogram(im.simple_imputations(gaps(spark, sf_dir), "qty"), "value", 50, ["variant"]).drop("left")


FACTORS = {"as_imputed": 1.0, "minus_10": 0.9, "plus_10": 1.1}


@query(
    "sensitivity",
    f"with d as (select *, (select min(qty) from {DN_SQL}) as lo, (select max(qty) from {DN_SQL}) as hi from {FILLED_SQL}), v as ("
    + " union all ".join(f"select '{n}' as scenario, coalesce(qty, filled * {f}::double) as x from d" for n, f in FACTORS.items())
    + " union all select 'lowest', coalesce(qty, lo) from d union all select 'highest', coalesce(qty, hi) from d) "
    "select scenario, round(avg(x), 6) as mean, round(median(x), 6) as median, round(stddev_samp(x), 6) as std, "
    "round(quantile_cont(x, 0.95), 6) as p95 from v group by scenario",
)
def sensitivity(spark, sf_dir):
    return rounded(im.sensitivity(gaps(spark, sf_dir), "qty", GROUP, FACTORS), 6, *STATS)
