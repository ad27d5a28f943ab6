"""Dates, casts, fills, maps and text lists over the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as sc
from tidemark.plans.registry import query, rounded, table


def dates_as_text():
    """Order dates written in one of three formats, as mixed inputs have them."""
    return (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MMM/yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "ddMMMyyyy"))
        .otherwise(F.date_format("o_orderdate", "EEE MMM d HH:mm:ss yyyy"))
    )


@query(
    "parse_multi_format",
    "select o_orderkey, strftime(case when o_orderkey % 3 = 2 then o_orderdate else date_trunc('day', o_orderdate) end, "
    "'%Y-%m-%d %H:%M:%S') as parsed from orders",
)
def parse_multi_format(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", dates_as_text().alias("text"))
    return orders.select(
        "o_orderkey", F.date_format(sc.parse_any(F.col("text")), "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query(
    "parse_strict_tolerant",
    "with t as (select o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') as good, case when o_orderkey % 7 = 0 "
    "then 'not a date' else strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') end as mixed from orders) select o_orderkey, "
    "strftime(strptime(good, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as strict, "
    "strftime(try_strptime(mixed, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as tolerant, "
    "strptime(good, '%d/%m/%Y %H:%M:%S') > timestamp '1998-01-01' as after_as_of from t",
)
def parse_strict_tolerant(spark, sf_dir):
    pattern = "dd/MM/yyyy HH:mm:ss"
    good = F.date_format("o_orderdate", pattern)
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", good.alias("good"), F.when(F.col("o_orderkey") % 7 == 0, "not a date").otherwise(good).alias("mixed")
    )
    strict, tolerant = sc.parse_timestamp(F.col("good"), pattern, strict=True), sc.parse_timestamp(F.col("mixed"), pattern)
    return text.select(
        "o_orderkey",
        F.date_format(strict, "yyyy-MM-dd HH:mm:ss").alias("strict"),
        F.date_format(tolerant, "yyyy-MM-dd HH:mm:ss").alias("tolerant"),
        (strict > F.lit("1998-01-01").cast("timestamp")).alias("after_as_of"),
    )


@query(
    "tenure_years",
    "with t as (select *, case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as d from orders), "
    "u as (select date_diff('day', d, date '2002-01-01') / 365.0 as years from t) "
    "select years < 6 as is_new, count(*) as len, round(min(years), 6) as min_years, round(max(years), 6) as max_years "
    "from u group by 1",
)
def tenure_years(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 11 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    years = sc.tenure_years(sc.parse_date_or_null(text), "2002-01-01")
    out = (
        table(spark, sf_dir, "orders")
        .select(years.alias("years"))
        .groupBy((F.col("years") < 6).alias("is_new"))
        .agg(F.count(F.lit(1)).alias("len"), F.min("years").alias("min_years"), F.max("years").alias("max_years"))
    )
    return rounded(out, 6, "min_years", "max_years")


@query(
    "casts_and_fills",
    "with t as (select p_partkey, case when p_partkey % 9 = 0 then null else p_name end as name, "
    "case when p_partkey % 7 = 0 then null else p_brand end as brand, "
    "case when p_partkey % 5 = 0 then '90%' else cast(p_size as varchar) end as size_text, p_retailprice from part) "
    "select p_partkey, coalesce(name, 'unknown_name_' || p_partkey) as name, coalesce(brand, 'unknown') as brand, "
    "try_cast(size_text as bigint) as size, cast(round(p_retailprice, 2) as double) as price, "
    "coalesce(try_cast(size_text as double), p_retailprice, 0) as size_or_price, cast(p_partkey as varchar) as key_text from t",
)
def casts_and_fills(spark, sf_dir):
    key = F.col("p_partkey")
    gaps = table(spark, sf_dir, "part").select(
        key,
        F.when(key % 9 != 0, F.col("p_name")).alias("name"),
        F.when(key % 7 != 0, F.col("p_brand")).alias("brand"),
        F.when(key % 5 == 0, "90%").otherwise(F.col("p_size").cast("string")).alias("size_text"),
        "p_retailprice",
    )
    named = gaps.withColumn("name", sc.unique_filler(F.col("name"), "unknown_name_", key))
    return sc.fill_text(named).select(
        key,
        "name",
        "brand",
        sc.cast_to(F.col("size_text"), "bigint", strict=False).alias("size"),
        F.round("p_retailprice", 2).alias("price"),
        sc.fill_chain(
            sc.cast_to(F.col("size_text"), "double", strict=False), F.col("p_retailprice"), F.lit(0.0)
        ).alias("size_or_price"),
        sc.cast_to(key, "string").alias("key_text"),
    )


@query(
    "map_flags",
    "select event_id, case event_type when 'click' then true when 'view' then false end as is_click, "
    "case event_id % 3 when 0 then true when 1 then false end as flag from events",
)
def map_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    letters = F.when(F.col("event_id") % 3 == 0, "t").when(F.col("event_id") % 3 == 1, "f").otherwise("?")
    return events.select(
        "event_id",
        sc.map_values(F.col("event_type"), {"click": True, "view": False}).alias("is_click"),
        sc.map_values(letters, sc.TRUE_FALSE).alias("flag"),
    )


@query(
    "explode_json_list",
    "with t as (select case when p_partkey % 13 = 0 then null when p_partkey % 10 = 0 then [] "
    "else string_split(p_name, ' ') || [p_type] end as l from part), "
    "e as (select unnest(l) as value from t where l is not null and len(l) > 0 union all "
    "select null from t where l is null or len(l) = 0) select value, count(*) as count from e group by value",
)
def explode_json_list(spark, sf_dir):
    key = F.col("p_partkey")
    listed = F.to_json(F.concat(F.split("p_name", " "), F.array("p_type")))
    text = F.when(key % 13 == 0, "not json").when(key % 10 == 0, "[]").otherwise(listed)
    exploded = sc.explode_json_list(table(spark, sf_dir, "part").select(text.alias("words")), "words")
    return exploded.groupBy("value").agg(F.count(F.lit(1)).alias("count"))


@query(
    "log1p_abs_round",
    "select event_id, round(ln(1 + greatest(value, 0)), 6) as log_value, round(abs(value - 50), 4) as distance, "
    "round((value - 50) * (value - 50), 4) as squared, round(sqrt(abs(value)), 6) as root, "
    "case when value = 0 then null else round(abs(50 - value) / value * 100, 4) end as change_percent, "
    "regexp_replace(event_type || ' #' || user_id, '[^\\p{L}\\p{N}_]+', '_', 'g') as identifier from events",
)
def log1p_abs_round(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.round(F.log1p(F.greatest(value, F.lit(0.0))), 6).alias("log_value"),
        F.round(F.abs(value - 50), 4).alias("distance"),
        F.round((value - 50) * (value - 50), 4).alias("squared"),
        F.round(F.sqrt(F.abs(value)), 6).alias("root"),
        F.round(sc.relative_change_percent(value, F.lit(50.0)), 4).alias("change_percent"),
        sc.sanitise_identifier(F.concat("event_type", F.lit(" #"), F.col("user_id").cast("string"))).alias("identifier"),
    )
