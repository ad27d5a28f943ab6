"""Missing-data study over the table with derived gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import missing as ms
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded, table


@query(
    "co_missing",
    "select price is null as price_missing, qty is null as qty_missing, count(*) as len, "
    f"round(100.0 * count(*) / (select count(*) from {DN_SQL}), 4) as percent from {DN_SQL} group by 1, 2",
)
def co_missing(spark, sf_dir):
    return rounded(ms.co_missing(derived_nulls(spark, sf_dir), "price", "qty"), 4, "percent")


@query(
    "missing_independence",
    "with c as (select count(*)::double as n, count(*) filter (price is null)::double as na, "
    "count(*) filter (qty is null)::double as nb, count(*) filter (price is null and qty is null)::double as nab "
    f"from {DN_SQL}) select round(na/n, 6) as share_a, round(nb/n, 6) as share_b, round(na/n*nb/n, 6) as expected, "
    "round(nab/n, 6) as observed, round(nab*n/(na*nb), 6) as lift, "
    "round(n * power(nab*(n-na-nb+nab) - (na-nab)*(nb-nab), 2) / (na*nb*(n-na)*(n-nb)), 3) as chi_square from c",
)
def missing_independence(spark, sf_dir):
    out = ms.missing_independence(derived_nulls(spark, sf_dir), "price", "qty")
    return rounded(rounded(out, 6, "share_a", "share_b", "expected", "observed", "lift"), 3, "chi_square")


@query(
    "missing_by_category",
    f"with g as (select * from {DN_SQL} where price is null and qty is null) select p_type, count(*) as len, "
    "round(100.0 * count(*) / (select count(*) from g), 4) as percent from g group by p_type",
)
def missing_by_category(spark, sf_dir):
    return rounded(ms.missing_by_category(derived_nulls(spark, sf_dir), ["price", "qty"], "p_type"), 4, "percent")


@query(
    "nullity_patterns",
    "select (l_tax is null)::int || '' || (price is null)::int || '' || (qty is null)::int as pattern, count(*) as count "
    f"from {DN_SQL} group by 1",
)
def nullity_patterns(spark, sf_dir):
    return ms.nullity_patterns(derived_nulls(spark, sf_dir), ["l_tax", "price", "qty"])


THREE = "(select *, case when l_linenumber = 3 then null else l_tax end as tax from {dn})".format(dn=DN_SQL)


def three_gaps(spark, sf_dir):
    return derived_nulls(spark, sf_dir).withColumn("tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))


@query(
    "nullity_corr",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr(({a} is null)::int, ({b} is null)::int), 6) as r from {THREE}"
        for a, b in (("price", "qty"), ("price", "tax"), ("qty", "tax"))
    ),
)
def nullity_corr(spark, sf_dir):
    # l_quantity has no gaps, so its pairs drop out
    return rounded(ms.nullity_corr(three_gaps(spark, sf_dir), ["price", "qty", "tax", "l_quantity"]), 6, "r")


@query(
    "nullity_distance",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(sqrt(count(*) filter (({a} is null) <> ({b} is null))), 6) as distance from {THREE}"
        for a, b in (("price", "qty"), ("price", "tax"), ("qty", "tax"))
    ),
)
def nullity_distance(spark, sf_dir):
    return rounded(ms.nullity_distance(three_gaps(spark, sf_dir), ["price", "qty", "tax"]), 6, "distance")


@query(
    "value_missing_corr",
    " union all ".join(
        f"select '{v}' as value_column, '{m}' as missing_column, "
        f"round(corr({v}, case when {v} is not null then ({m} is null)::int end), 6) as r from {DN_SQL}"
        for v in ("l_extendedprice", "qty", "price", "p_size")
        for m in ("price", "qty")
        if v != m
    ),
)
def value_missing_corr(spark, sf_dir):
    out = ms.value_missing_corr(
        derived_nulls(spark, sf_dir), ["l_extendedprice", "qty", "price", "p_size"], ["price", "qty"]
    )
    return rounded(out, 6, "r")


@query(
    "missing_present_summary",
    "with s as (select qty is null as is_missing, count(l_extendedprice) as count, min(l_extendedprice) as min, "
    "max(l_extendedprice) as max, avg(l_extendedprice) as mean, avg(ln(1 + l_extendedprice)) as mean_log1p, "
    "quantile_cont(l_extendedprice, 0.25) as q25, quantile_cont(l_extendedprice, 0.5) as q50, "
    f"quantile_cont(l_extendedprice, 0.75) as q75 from {DN_SQL} group by 1) select is_missing, count, min, max, "
    "round(mean, 4) as mean, round(mean_log1p, 6) as mean_log1p, round(q25, 4) as q25, round(q50, 4) as q50, "
    "round(q75, 4) as q75, round(q25 - 1.5 * (q75 - q25), 3) as lower_fence, "
    "round(q75 + 1.5 * (q75 - q25), 3) as upper_fence from s",
)
def missing_present_summary(spark, sf_dir):
    out = ms.missing_present_summary(derived_nulls(spark, sf_dir), "l_extendedprice", F.col("qty").isNull())
    out = rounded(rounded(out, 4, "mean", "q25", "q50", "q75"), 6, "mean_log1p")
    return rounded(out, 3, "lower_fence", "upper_fence")


@query(
    "structural_flags",
    "select price is not null or qty is not null as has_value, qty is null as qty_missing, price is null as price_missing, "
    f"count(*) as len from {DN_SQL} group by 1, 2, 3",
)
def structural_flags(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir)
    flagged = ms.missing_flags(dn.withColumn("has_value", ms.any_present(dn, ["price", "qty"])), ["qty", "price"])
    return flagged.groupBy("has_value", "qty_missing", "price_missing").agg(F.count(F.lit(1)).alias("len"))


@query("little_mcar")
def little_mcar(spark, sf_dir):
    return ms.little_mcar(three_gaps(spark, sf_dir), ["qty", "price", "tax", "l_discount"])


COV_SQL = (
    "o as (select avg(qty) as mq, avg(price) as mp, var_samp(qty) as vq, var_samp(price) as vp, "
    f"covar_samp(qty, price) as vc from {DN_SQL})"
)


@query(
    "little_mcar_pair",
    f"with {COV_SQL}, g as (select qty is null as nq, price is null as np, count(*) as n, avg(qty) - any_value(mq) as dq, "
    f"avg(price) - any_value(mp) as dp, any_value(vq) as vq, any_value(vp) as vp, any_value(vc) as vc from {DN_SQL}, o where qty is not null or price is not null group by all), "
    "d as (select sum(n * case when nq then dp * dp / vp when np then dq * dq / vq else "
    "(dq * dq * vp - 2 * dq * dp * vc + dp * dp * vq) / (vq * vp - vc * vc) end) as s from g) "
    "select round(s, 3) as statistic, 2::bigint as dof, round(exp(-s / 2), 6) as p_value from d",
)
def little_mcar_pair(spark, sf_dir):
    out = ms.little_mcar(derived_nulls(spark, sf_dir), ["qty", "price"])
    return rounded(rounded(out, 3, "statistic"), 6, "p_value")


@query(
    "missing_auc_single",
    f"with g as (select l_quantity as s, count(*) filter (price is null) as pos, count(*) filter (price is not null) as neg "
    f"from {DN_SQL} group by 1), r as (select *, coalesce(sum(neg) over (order by s rows between unbounded preceding and "
    "1 preceding), 0) as below from g) select round(sum(pos * (below + neg / 2.0)) / (sum(pos)::double * sum(neg)), 6) as auc from r",
)
def missing_auc_single(spark, sf_dir):
    """With one feature the model's ranking is the feature's own."""
    return rounded(ms.missing_auc(derived_nulls(spark, sf_dir), "price", ["l_quantity"]), 6, "auc")


@query("missing_auc")
def missing_auc(spark, sf_dir):
    return ms.missing_auc(derived_nulls(spark, sf_dir), "price", ["qty", "l_discount", "p_size"])


@query(
    "auc_by_ranks",
    "with t as (select value as s, (event_type = 'error')::int as y from events), g as (select s, sum(y) as pos, "
    "sum(1 - y) as neg from t group by s), r as (select *, coalesce(sum(neg) over (order by s rows between unbounded "
    "preceding and 1 preceding), 0) as below from g) "
    "select round(sum(pos * (below + neg / 2.0)) / (sum(pos)::double * sum(neg)), 8) as auc from r",
)
def auc_by_ranks(spark, sf_dir):
    scored = table(spark, sf_dir, "events").select(
        F.col("value").alias("score"), (F.col("event_type") == "error").cast("int").alias("label")
    )
    return rounded(ms.auc_by_ranks(scored, "score", "label"), 8, "auc")
