"""Grouped, windowed and conditional SQL over the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import parse_timestamp
from tidemark.operators import aggregates as agg
from tidemark.operators.unions import add_suffix
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded, table

LARGE = 31_000_000


@query(
    "group_sum_ranked",
    "select l_suppkey, round(sum(l_extendedprice), 2) as total, count(*) as n_rows from lineitem "
    "group by l_suppkey order by total desc, l_suppkey",
)
def group_sum_ranked(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("total"), "l_suppkey")
    )


@query(
    "having_total",
    "select l_suppkey, round(sum(l_extendedprice), 2) as total from lineitem group by l_suppkey "
    f"having sum(l_extendedprice) > {LARGE}",
)
def having_total(spark, sf_dir):
    return rounded(agg.groups_above(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", LARGE), 2, "total")


@query(
    "cte_having_count",
    "with big as (select l_suppkey, sum(l_extendedprice) as total from lineitem group by l_suppkey "
    f"having sum(l_extendedprice) > {LARGE}) select count(*) as n_groups from big",
)
def cte_having_count(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(
        f"""with big as (
              select l_suppkey, sum(l_extendedprice) as total from lineitem group by l_suppkey having total > {LARGE}
            )
            select count(*) as n_groups from big"""
    )


@query(
    "max_group",
    "with t as (select l_suppkey, round(sum(l_quantity), 2) as total from lineitem group by l_suppkey) "
    "select * from t where total = (select max(total) from t)",
)
def max_group(spark, sf_dir):
    return agg.max_groups(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", 2)


@query(
    "top_group",
    "select l_suppkey, round(sum(l_extendedprice), 2) as total from lineitem group by l_suppkey "
    "order by sum(l_extendedprice) desc, l_suppkey limit 1",
)
def top_group(spark, sf_dir):
    totals = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("total"))
    return rounded(agg.top_rows(totals, "total", 1, "l_suppkey"), 2, "total")


@query(
    "window_sum_rownum",
    "select row_number() over (order by o_orderkey) as row_num, o_orderkey, o_custkey, "
    "round(sum(o_totalprice) over (partition by o_custkey), 2) as customer_total from orders",
)
def window_sum_rownum(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    totals = agg.group_total_on_rows(orders, "o_custkey", "o_totalprice", "customer_total")
    numbered = agg.numbered_rows(totals, ["o_orderkey"])
    return rounded(numbered.select("row_num", "o_orderkey", "o_custkey", "customer_total"), 2, "customer_total")


@query(
    "filter_counts",
    "select count(*) filter (where value <= 0) as non_positive, "
    "count(*) filter (where event_type = 'error' and value > 10) as large_errors, "
    "count(*) filter (where value <= 0 or event_type is null) as any_invalid, "
    "round(100.0 * count(*) filter (where value <= 0) / count(*), 4) as non_positive_percent, "
    "round(100.0 * count(*) filter (where event_type = 'error' and value > 10) / count(*), 4) as large_errors_percent, "
    "round(100.0 * count(*) filter (where value <= 0 or event_type is null) / count(*), 4) as any_invalid_percent "
    "from events",
)
def filter_counts(spark, sf_dir):
    value, kind = F.col("value"), F.col("event_type")
    rules = {
        "non_positive": value <= 0,
        "large_errors": (kind == "error") & (value > 10),
        "any_invalid": (value <= 0) | kind.isNull(),
    }
    out = agg.conditional_counts(table(spark, sf_dir, "events"), rules, percent=True)
    return rounded(out, 4, *[f"{n}_percent" for n in rules])


@query(
    "rule_block",
    "with t as (select *, case when o_orderkey % 53 = 0 then 'n/a' else strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') end "
    "as created from orders) select count(*) filter (where o_custkey is null) as missing_ids, "
    "count(*) filter (where o_totalprice < 0) as negative_amount, "
    "count(*) filter (where try_strptime(created, '%d/%m/%Y %H:%M:%S') < timestamp '1994-01-01') as before_start, "
    "count(*) filter (where try_strptime(created, '%d/%m/%Y %H:%M:%S') > timestamp '1998-01-01') as after_as_of, "
    "count(*) filter (where try_strptime(created, '%d/%m/%Y %H:%M:%S') is null) as invalid_datetime_format, "
    "count(*) filter (where o_orderpriority is null and o_custkey is not null) as missing_priority from t",
)
def rule_block(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    created = F.when(F.col("o_orderkey") % 53 == 0, "n/a").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    )
    parsed = parse_timestamp(F.col("created"), "dd/MM/yyyy HH:mm:ss")
    return agg.conditional_counts(
        orders.withColumn("created", created).withColumn("created_at", parsed),
        {
            "missing_ids": F.col("o_custkey").isNull(),
            "negative_amount": F.col("o_totalprice") < 0,
            "before_start": F.col("created_at") < F.lit("1994-01-01").cast("timestamp"),
            "after_as_of": F.col("created_at") > F.lit("1998-01-01").cast("timestamp"),
            "invalid_datetime_format": F.col("created_at").isNull(),
            "missing_priority": F.col("o_orderpriority").isNull() & F.col("o_custkey").isNotNull(),
        },
    )


@query(
    "distinct_count",
    "select count(distinct event_type) as event_type, count(distinct user_id) as user_id from events",
)
def distinct_count(spark, sf_dir):
    return agg.distinct_counts(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query(
    "value_counts_many",
    " union all ".join(
        f"select '{c}' as \"column\", cast({c} as varchar) as value, count(*) as count from part group by {c}"
        for c in ("p_brand", "p_type", "p_size")
    ),
)
def value_counts_many(spark, sf_dir):
    return agg.value_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query(
    "percent_by_group",
    "select event_type, count(*) as len, round(100.0 * count(*) / (select count(*) from events), 4) as percent "
    "from events group by event_type",
)
def percent_by_group(spark, sf_dir):
    return rounded(agg.percent_by_group(table(spark, sf_dir, "events"), ["event_type"]), 4, "percent")


@query(
    "first_row_transposed",
    "with f as (select * from part order by p_partkey limit 1) "
    + " union all ".join(
        f"select '{c}' as column_name, cast({c} as varchar) as value from f"
        for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    ),
)
def first_row_transposed(spark, sf_dir):
    return agg.transpose_row(agg.first_row(table(spark, sf_dir, "part"), "p_partkey"))


@query(
    "argmax_rows",
    "select c_custkey, c_name, c_acctbal from customer where c_acctbal = (select max(c_acctbal) from customer)",
)
def argmax_rows(spark, sf_dir):
    return agg.rows_at_maximum(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_acctbal")


@query(
    "select_rename_filter",
    "select p_partkey as part_key, p_brand as brand, p_type as part_type, p_size as size, "
    "case when p_size <= 10 then 'small' when p_size <= 30 then 'medium' else 'large' end as size_class from part "
    "where (p_size between 5 and 40) and p_type in ('ECONOMY', 'STANDARD') and p_brand is not null "
    "and not (p_retailprice < 900.5)",
)
def select_rename_filter(spark, sf_dir):
    size = F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .where(size.between(5, 40) & F.col("p_type").isin("ECONOMY", "STANDARD"))
        .where(F.col("p_brand").isNotNull() & ~(F.col("p_retailprice") < 900.5))
        .withColumnsRenamed({"p_partkey": "part_key", "p_brand": "brand", "p_type": "part_type", "p_size": "size"})
        .withColumn(
            "size_class",
            F.when(F.col("size") <= 10, "small").when(F.col("size") <= 30, "medium").otherwise("large"),
        )
        .drop("p_name", "p_retailprice")
    )


@query(
    "crosstab",
    f"select p_brand, count(*) filter (where qty is not null) as present, count(*) filter (where qty is null) as missing "
    f"from {DN_SQL} where p_brand is not null group by p_brand",
)
def crosstab(spark, sf_dir):
    return agg.crosstab(
        derived_nulls(spark, sf_dir), "p_brand", F.col("qty").isNull(), {False: "present", True: "missing"}
    )


@query(
    "flag_rate_by_group",
    f"select price is null as price_missing, round(avg((qty is null)::int), 6) as qty_missing_rate from {DN_SQL} group by 1",
)
def flag_rate_by_group(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir).withColumn("price_missing", F.col("price").isNull())
    out = agg.flag_rates(dn, ["price_missing"], {"qty_missing_rate": F.col("qty").isNull()})
    return rounded(out, 6, "qty_missing_rate")


@query(
    "named_group_agg",
    "select p_type, count(*) as total_rows, count(*) filter (where qty is null) as missing_count, "
    f"round(avg((qty is null)::int), 6) as missing_ratio from {DN_SQL} where p_type is not null group by p_type",
)
def named_group_agg(spark, sf_dir):
    return rounded(agg.missing_by_group(derived_nulls(spark, sf_dir), ["p_type"], "qty"), 6, "missing_ratio")


TOP_SQL = (
    "with a as (select p_brand, avg(qty) as v from {dn} group by p_brand order by v desc nulls first, p_brand limit 10), "
    "b as (select p_brand, avg(l_quantity) as v from {dn} group by p_brand order by v desc nulls first, p_brand limit 10) "
    "select count(*) as overlap, string_agg(p_brand, ', ' order by p_brand) as members from a where p_brand in "
    "(select p_brand from b)"
)


@query("top_k_overlap", TOP_SQL.format(dn=DN_SQL))
def top_k_overlap(spark, sf_dir):
    means = derived_nulls(spark, sf_dir).groupBy("p_brand").agg(F.avg("qty").alias("a"), F.avg("l_quantity").alias("b"))
    return agg.top_k_overlap(means, means, "p_brand", "a", "b", 10)


@query(
    "stats_cross_join",
    "select round(avg(qty), 6) as mean, round(stddev_samp(qty), 6) as std, round(avg(l_quantity), 6) as mean_full, "
    "round(stddev_samp(l_quantity), 6) as std_full, "
    f"round(abs(avg(l_quantity) - avg(qty)) / avg(qty) * 100, 6) as mean_change_percent from {DN_SQL}",
)
def stats_cross_join(spark, sf_dir):
    # two one-row blocks over the same rows: computed side by side in one pass instead of joined
    return derived_nulls(spark, sf_dir).agg(
        F.round(F.avg("qty"), 6).alias("mean"),
        F.round(F.stddev_samp("qty"), 6).alias("std"),
        F.round(F.avg("l_quantity"), 6).alias("mean_full"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("std_full"),
        F.round(F.try_divide(F.abs(F.avg("l_quantity") - F.avg("qty")), F.avg("qty")) * 100, 6).alias("mean_change_percent"),
    )


@query(
    "group_rank_join",
    "with a as (select p_brand, avg(qty) as v from {dn} where qty is not null group by p_brand), b as (select p_brand, "
    "avg(l_quantity) as v from {dn} group by p_brand) select a.p_brand, round(a.v, 6) as avg_qty, "
    "round(b.v, 6) as avg_qty_full from a join b on a.p_brand = b.p_brand".replace("{dn}", DN_SQL),
)
def group_rank_join(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir)
    kept = agg.group_mean_ranked(dn.where(F.col("qty").isNotNull()), "p_brand", "qty", "avg_qty")
    full = agg.group_mean_ranked(dn, "p_brand", "l_quantity", "avg_qty")
    return rounded(agg.group_rank_join(kept, full, "p_brand", "_full"), 6, "avg_qty", "avg_qty_full")


@query(
    "unique_flagged_values",
    "select distinct 'text' as \"column\", text as value from documents where regexp_matches(text, '[^\\x00-\\x7F]') "
    "union select distinct 'source', source from documents where regexp_matches(source, '[^\\x00-\\x7F]')",
)
def unique_flagged_values(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return agg.unique_flagged_values(docs, {c: F.col(c).rlike(r"[^\x00-\x7F]") for c in ("text", "source")})


@query(
    "add_suffix_columns",
    "select c_custkey as c_custkey_right, c_mktsegment as c_mktsegment_right from customer",
)
def add_suffix_columns(spark, sf_dir):
    return add_suffix(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "_right")
