"""Outliers, thresholds, histograms and normality over the business tables."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tidemark.operators import outliers as ou
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded, table


@query(
    "range_to_null",
    "select l_orderkey, l_linenumber, l_partkey, case when l_quantity <= 0 or l_quantity >= 45 then null else l_quantity end "
    "as open_range, case when l_quantity <= 0 or l_quantity > 45 then null else l_quantity end as closed_range from lineitem",
)
def range_to_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    opened = ou.range_to_null(lines, "l_quantity", 0, 45, into="open_range")
    return ou.range_to_null(opened, "l_quantity", 0, 45, upper_inclusive=True, into="closed_range").drop("l_quantity")


SWEEP = [10.0, 20.0, 30.0, 40.0]


@query(
    "threshold_sweep",
    " union all ".join(
        f"select '{label}' as threshold, count(v) as count, count(*) - count(v) as null_count, round(avg(v), 6) as mean, "
        "round(stddev_samp(v), 6) as std, min(v) as min, max(v) as max, quantile_cont(v, 0.25) as q25, "
        f"quantile_cont(v, 0.5) as q50, quantile_cont(v, 0.75) as q75, {above} as n_above from "
        f"(select l_quantity, {expr} as v from lineitem)"
        for label, expr, above in [("none", "l_quantity", "0")]
        + [
            (str(t), f"case when l_quantity <= {t} then l_quantity end", f"count(*) filter (l_quantity > {t})")
            for t in SWEEP
        ]
    ),
)
def threshold_sweep(spark, sf_dir):
    return rounded(ou.threshold_sweep(table(spark, sf_dir, "lineitem"), "l_quantity", SWEEP), 6, "mean", "std")


@query(
    "suspicious_range",
    "with s as (select l_quantity from lineitem where l_quantity > 40 and l_quantity <= 45) select l_quantity, "
    "count(*) as len, round(100.0 * count(*) / (select count(*) from s), 4) as percent from s group by l_quantity",
)
def suspicious_range(spark, sf_dir):
    return rounded(ou.value_frequency(table(spark, sf_dir, "lineitem"), "l_quantity", 40, 45), 4, "percent")


@query("validity_split", f"select qty > 0 and qty <= 20 as is_valid, count(*) as len from {DN_SQL} group by 1")
def validity_split(spark, sf_dir):
    return ou.validity_split(derived_nulls(spark, sf_dir), "qty", 0, 20)


@query(
    "year_out_of_range",
    "select year(o_orderdate)::int as value, count(*) as count, round(100.0 * count(*) / (select count(*) from orders), 4) as percent "
    "from orders where not (year(o_orderdate) between 1994 and 1997) group by 1",
)
def year_out_of_range(spark, sf_dir):
    out = ou.out_of_range_counts(table(spark, sf_dir, "orders"), F.year("o_orderdate"), 1994, 1997)
    return rounded(out, 4, "percent")


@query(
    "outlier_flags",
    "with s as (select quantile_cont(c_acctbal, 0.25) as q1, quantile_cont(c_acctbal, 0.75) as q3, avg(c_acctbal) as m, "
    "stddev_samp(c_acctbal) as sd from customer) select c_custkey, c_acctbal, "
    "c_acctbal < q1 - 0.4 * (q3 - q1) or c_acctbal > q3 + 0.4 * (q3 - q1) as iqr_outlier, "
    "abs((c_acctbal - m) / sd) > 1.6 as z_outlier from customer, s",
)
def outlier_flags(spark, sf_dir):
    return ou.outlier_flags(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0.4, 1.6)


HIST = (
    "with s as (select min({c}) as lo, max({c}) as hi from {t}), b as (select t.*, lo, (hi - lo) / {n} as w, "
    "least(cast(floor(({c} - lo) / ((hi - lo) / {n})) as int), {n} - 1) as bin from {t} t, s where {c} is not null) "
)


@query(
    "histogram",
    HIST.format(c="l_extendedprice", t="lineitem", n=50)
    + "select bin, round(min(lo) + bin * min(w), 4) as \"left\", count(*) as count from b group by bin",
)
def histogram(spark, sf_dir):
    return rounded(ou.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 50), 4, "left")


@query(
    "histogram_by_flag",
    HIST.format(c="l_extendedprice", t=DN_SQL, n=5)
    + "select qty is null as is_missing, bin, round(min(lo) + bin * min(w), 4) as \"left\", count(*) as count from b group by 1, 2",
)
def histogram_by_flag(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir).select("l_extendedprice", F.col("qty").isNull().alias("is_missing"))
    return rounded(ou.histogram(dn, "l_extendedprice", 5, ["is_missing"]), 4, "left")


@query(
    "binned_counts",
    "with s as (select min(value) as lo, max(value) as hi from events) select "
    "least(greatest(cast(ceil((value - lo) / ((hi - lo) / 10)) as int), 1), 10) as bin, count(*) as count "
    "from events, s where value is not null group by 1",
)
def binned_counts(spark, sf_dir):
    return ou.binned_counts(table(spark, sf_dir, "events"), "value", 10)


@query(
    "qq_points",
    " union all ".join(
        f"select round({i}/100.0::double, 4) as prob, round({NormalDist().inv_cdf(i / 100)!r}::double, 6) as theoretical, "
        f"round(quantile_cont(value, {i / 100}), 4) as sample from events"
        for i in range(1, 100)
    ),
)
def qq_points(spark, sf_dir):
    out = ou.qq_points(table(spark, sf_dir, "events"), "value")
    return rounded(rounded(out, 4, "prob", "sample"), 6, "theoretical")


@query("ks_test")
def ks_test(spark, sf_dir):
    return ou.ks_test(table(spark, sf_dir, "events"), "value")


@query(
    "dagostino_k2",
    "with p as (select value as v, avg(value) over () as m from events), "
    "m as (select count(v)::double as n, avg(power(v - m, 3)) / power(avg(power(v - m, 2)), 1.5) as g1, "
    "avg(power(v - m, 4)) / power(avg(power(v - m, 2)), 2) as b2 from p), "
    "s as (select *, g1 * sqrt((n+1)*(n+3)/(6*(n-2))) as y, "
    "3*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) as beta2, "
    "(b2 - 3*(n-1)/(n+1)) / sqrt(24*n*(n-2)*(n-3)/((n+1)*(n+1)*(n+3)*(n+5))) as x, "
    "6*(n*n-5*n+2)/((n+7)*(n+9)) * sqrt(6*(n+3)*(n+5)/(n*(n-2)*(n-3))) as sb from m), "
    "q as (select *, sqrt(2*(beta2-1)) - 1 as w2, 6 + 8/sb*(2/sb + sqrt(1+4/(sb*sb))) as a from s), "
    "r as (select *, y / sqrt(2/(w2-1)) as t, 1 + x*sqrt(2/(a-4)) as d from q), "
    "z as (select ln(t + sqrt(t*t+1)) / sqrt(ln(w2)/2) as z1, "
    "(1 - 2/(9*a) - sign(d)*cbrt((1-2/a)/abs(d))) / sqrt(2/(9*a)) as z2 from r) "
    "select round(z1, 4) as z_skew, round(z2, 4) as z_kurtosis, round(z1*z1 + z2*z2, 3) as k2, "
    "round(exp(-(z1*z1 + z2*z2)/2), 6) as p_value from z",
)
def dagostino_k2(spark, sf_dir):
    out = ou.dagostino_k2(table(spark, sf_dir, "events"), "value")
    return rounded(rounded(rounded(out, 4, "z_skew", "z_kurtosis"), 3, "k2"), 6, "p_value")
