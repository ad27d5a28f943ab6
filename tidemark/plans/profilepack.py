"""Profiles of the table with derived gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import impute as im
from tidemark.operators import profile as pf
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded, table

DN_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz", "p_partkey": "bigint",
    "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double",
    "qty": "double", "price": "double",
}
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "qty", "price"]


def per_column_sql(template: str, columns, source: str = "d") -> str:
    return f"with d as (select * from {DN_SQL}) " + " union all ".join(
        template.format(c=c, t=DN_COLUMNS[c]) for c in columns
    )


@query(
    "schema_table",
    "with n as (select count(*) as n from lineitem) select c as \"column\", t as dtype, n as n_rows from n, (values "
    + ", ".join(f"('{c}', '{t}')" for c, t in DN_COLUMNS.items() if c.startswith("l_"))
    + ") v(c, t)",
)
def schema_table(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return pf.schema_table(lineitem).withColumn("n_rows", pf.shape(lineitem).select("rows").scalar())


@query(
    "nonnull_percent",
    per_column_sql(
        "select '{c}' as \"column\", count({c}) as non_null, round(100.0 * count({c}) / count(*), 4) as percent from d",
        DN_COLUMNS,
    ),
)
def nonnull_percent(spark, sf_dir):
    return rounded(pf.nonnull_percent(derived_nulls(spark, sf_dir)), 4, "percent")


@query(
    "null_report",
    "select * from ("
    + per_column_sql(
        "select '{c}' as \"column\", count(*) filter ({c} is null) as null_count, "
        "round(100.0 * count(*) filter ({c} is null) / count(*), 2) as null_percent, '{t}' as dtype from d",
        DN_COLUMNS,
    )
    + ") where null_count > 0",
)
def null_report(spark, sf_dir):
    return pf.null_report(derived_nulls(spark, sf_dir))


@query(
    "describe_all",
    per_column_sql(
        "select '{c}' as \"column\", count({c}) as count, count(*) - count({c}) as null_count, round(avg({c}), 4) as mean, "
        "round(stddev_samp({c}), 4) as std, min({c}) as min, max({c}) as max, quantile_cont({c}, 0.25) as q25, "
        "quantile_cont({c}, 0.5) as q50, quantile_cont({c}, 0.75) as q75 from d",
        NUMBERS,
    ).replace("quantile_cont({c}, 0.25)", "round(quantile_cont({c}, 0.25), 4)"),
)
def describe_all(spark, sf_dir):
    return rounded(pf.describe(derived_nulls(spark, sf_dir), NUMBERS), 4, "mean", "std")


@query(
    "summarize_all",
    per_column_sql(
        "select '{c}' as \"column\", '{t}' as dtype, round(avg({c}), 4) as avg, round(stddev_samp({c}), 4) as std, "
        "count(*) as count, round(100.0 * (count(*) - count({c})) / count(*), 4) as null_percent from d",
        [c for c, t in DN_COLUMNS.items() if t in ("bigint", "int", "double")],
    )
    + " union all "
    + " union all ".join(
        f"select '{c}', '{t}', null, null, count(*), 0 from d" for c, t in DN_COLUMNS.items() if t in ("string", "timestamp_ntz")
    ),
)
def summarize_all(spark, sf_dir):
    # sketch-based fields (distinct counts, quartiles) are left out of the exact comparison
    out = pf.summarize(derived_nulls(spark, sf_dir))
    return rounded(out.select("column", "dtype", "avg", "std", "count", "null_percent"), 4, "avg", "std", "null_percent")


@query("summarize_sketches")
def summarize_sketches(spark, sf_dir):
    return pf.summarize(derived_nulls(spark, sf_dir))


CONSTANT_EXTRA = "case when l_orderkey % 4 = 0 then qty end as rare, 1.0::double as fixed"


@query(
    "constant_columns",
    f"with d as (select *, {CONSTANT_EXTRA} from {DN_SQL}) "
    + " union all ".join(
        f"select '{c}' as \"column\", count(distinct {c}) <= 1 as is_constant, "
        f"round(avg(({c} is null)::int), 6) as missing_ratio, "
        f"count(distinct {c}) > 1 and avg(({c} is null)::int) < 0.7 as keep from d"
        for c in ("l_quantity", "p_size", "qty", "price", "rare", "fixed")
    ),
)
def constant_columns(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir).select(
        "l_quantity", "p_size", "qty", "price",
        F.when(F.col("l_orderkey") % 4 == 0, F.col("qty")).alias("rare"), F.lit(1.0).alias("fixed"),
    )
    return rounded(pf.constant_columns(dn), 6, "missing_ratio")


@query(
    "stat_block",
    "select round(avg(l_extendedprice), 4) as mean, round(median(l_extendedprice), 4) as median, "
    "round(stddev_samp(l_extendedprice), 4) as std, round(quantile_cont(l_extendedprice, 0.95), 4) as p95 from lineitem",
)
def stat_block(spark, sf_dir):
    out = pf.stat_block(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return rounded(out, 4, "mean", "median", "std", "p95")


@query(
    "stat_block_by_group",
    "select l_returnflag, l_linestatus, round(avg(l_quantity), 4) as mean, round(median(l_quantity), 4) as median, "
    "round(stddev_samp(l_quantity), 4) as std, round(quantile_cont(l_quantity, 0.95), 4) as p95 from lineitem group by all",
)
def stat_block_by_group(spark, sf_dir):
    out = pf.stat_block(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag", "l_linestatus"])
    return rounded(out, 4, "mean", "median", "std", "p95")


PROBS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query(
    "quantile_list",
    " union all ".join(
        f"select {p}::double as prob, round(quantile_cont(l_extendedprice, {p}), 4) as quantile from lineitem"
        for p in [*PROBS, 1.0]
    ),
)
def quantile_list(spark, sf_dir):
    return rounded(pf.quantile_list(table(spark, sf_dir, "lineitem"), "l_extendedprice", PROBS), 4, "quantile")


@query(
    "pair_corr",
    "select round(corr(l_quantity, l_extendedprice), 6) as l_quantity__l_extendedprice, "
    f"round(corr(qty, price), 6) as qty__price, round(corr(p_size, p_retailprice), 6) as p_size__p_retailprice from {DN_SQL}",
)
def pair_corr(spark, sf_dir):
    pairs = [("l_quantity", "l_extendedprice"), ("qty", "price"), ("p_size", "p_retailprice")]
    out = pf.pair_corr(derived_nulls(spark, sf_dir), pairs)
    return rounded(out, 6, *out.columns)


@query(
    "shape_moments",
    " union all ".join(
        f"select '{c}' as \"column\", round(avg(power({c} - m, 3)) / power(max(s), 3), 5) as skewness, "
        f"round(kurtosis_pop({c}), 5) as kurtosis from (select {c}, avg({c}) over () as m, stddev_pop({c}) over () as s from lineitem)"
        for c in ("l_extendedprice", "l_quantity", "l_discount")
    ),
)
def shape_moments(spark, sf_dir):
    out = pf.shape_moments(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"])
    return rounded(out, 5, "skewness", "kurtosis")


@query(
    "group_median_on_rows",
    "select o_orderkey, o_orderpriority, round(median(o_totalprice) over (partition by o_orderpriority), 4) as group_median "
    "from orders",
)
def group_median_on_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = im.group_median_on_rows(orders, "o_totalprice", ["o_orderpriority"], "group_median").drop("o_totalprice")
    return rounded(out, 4, "group_median")
