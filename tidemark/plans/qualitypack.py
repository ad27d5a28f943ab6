"""Validation log, duplicate marks and star model."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as ql
from tidemark.plans.registry import DN_SQL, derived_nulls, query, table


@query(
    "validation_log",
    "select doc_id, 'empty_source' as rule, 'source' as \"column\", source as value from documents where trim(source) = '' "
    "union all select doc_id, 'unknown_lang', 'lang', lang from documents where lang not in ('en', 'fr') "
    "union all select doc_id, 'too_short', 'n_chars', cast(n_chars as varchar) from documents where n_chars < 200 "
    "union all select doc_id, 'too_long', 'n_chars', cast(n_chars as varchar) from documents where n_chars > 20000",
)
def validation_log(spark, sf_dir):
    return ql.validation_log(
        table(spark, sf_dir, "documents"),
        "doc_id",
        {
            "empty_source": ("source", F.trim("source") == ""),
            "unknown_lang": ("lang", ~F.col("lang").isin("en", "fr")),
            "too_short": ("n_chars", F.col("n_chars") < 200),
            "too_long": ("n_chars", F.col("n_chars") > 20000),
        },
    )


@query(
    "mark_duplicates",
    "select doc_id, lang, count(*) over (partition by text, lang) as copies, "
    "doc_id <> min(doc_id) over (partition by text, lang) as is_repeat from documents",
)
def mark_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return ql.mark_duplicates(docs, "doc_id", ["text", "lang"]).drop("text")


@query(
    "star_model",
    "with d1 as (select row_number() over (order by p_brand, p_type) as part_key, * from "
    f"(select distinct p_brand, p_type from {DN_SQL})), d2 as (select row_number() over (order by l_returnflag, l_linestatus) "
    f"as status_key, * from (select distinct l_returnflag, l_linestatus from {DN_SQL})) "
    f"select part_key, status_key, count(*) as rows, round(sum(l_quantity), 2) as quantity from {DN_SQL} f "
    "join d1 using (p_brand, p_type) join d2 using (l_returnflag, l_linestatus) group by all",
)
def star_model(spark, sf_dir):
    flat = derived_nulls(spark, sf_dir).select("p_brand", "p_type", "l_returnflag", "l_linestatus", "l_quantity")
    fact, _ = ql.star_model(flat, {"part_key": ["p_brand", "p_type"], "status_key": ["l_returnflag", "l_linestatus"]})
    return fact.groupBy("part_key", "status_key").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
