"""Reconciliation of orders with an edited copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reconcile as rc
from tidemark.plans.registry import query, table

COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice"]
SRC = "(select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders)"
TGT = (
    "(select o_orderkey, o_custkey, case when o_orderkey % 211 = 0 then null else o_orderstatus end as o_orderstatus, "
    "case when o_orderkey % 101 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders "
    "where o_orderkey % 503 <> 0)"
)


def sides(spark, sf_dir, *extra):
    source = table(spark, sf_dir, "orders").select("o_orderkey", *COLUMNS, *extra)
    key = F.col("o_orderkey")
    target = source.where(key % 503 != 0).withColumns(
        {
            "o_orderstatus": F.when(key % 211 != 0, F.col("o_orderstatus")),
            "o_totalprice": F.when(key % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        }
    )
    return source, target


def status_rows(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 503 == 0, "Object Mismatch")
        .when((key % 211 == 0) | (key % 101 == 0), "Field Mismatch")
        .otherwise("Match")
        .alias("comparison_status"),
        F.concat(F.lit("rule "), (key % 3).cast("string")).alias("details"),
    )


def sheet_rows(spark, sf_dir):
    """The comparison as a report sheet: two header rows, then one row of text cells per order."""
    source, target = sides(spark, sf_dir)
    pairs = rc.paired(source, target, ["o_orderkey"], COLUMNS).join(status_rows(spark, sf_dir), "o_orderkey")
    head = spark.createDataFrame(
        [
            (0, ["Source", None, "UNNAMED_2", "Destination", "", "UNNAMED_5", "Comparison Result", "Transform Details"]),
            (1, ["o_custkey", "o_orderstatus", "o_totalprice"] * 2 + ["Comparison Status", "Details"]),
        ],
        "row_idx long, cells array<string>",
    )
    text = [F.col(f"{side}.{c}").cast("string") for side in "st" for c in COLUMNS]
    body = pairs.select(
        (F.col("o_orderkey") + 2).alias("row_idx"), F.array(*text, "comparison_status", "details").alias("cells")
    )
    return head.unionByName(body)


STATUS_SQL = (
    "case when o_orderkey % 503 = 0 then 'Object Mismatch' when o_orderkey % 211 = 0 or o_orderkey % 101 = 0 "
    "then 'Field Mismatch' else 'Match' end"
)
PAIR_SQL = (
    f"(select o_orderkey, s.o_custkey as s1, s.o_orderstatus as s2, s.o_totalprice as s3, t.o_custkey as t1, "
    f"t.o_orderstatus as t2, t.o_totalprice as t3, t.o_custkey is null as gone, {STATUS_SQL} as st "
    f"from {SRC} s left join {TGT} t using (o_orderkey))"
)


@query(
    "header_promotion",
    "select o_orderkey + 2 as row_idx, cast(s1 as varchar) as \"Source__o_custkey\", s2 as \"Source__o_orderstatus\", "
    "cast(s3 as varchar) as \"Source__o_totalprice\", cast(t1 as varchar) as \"Destination__o_custkey\", "
    "t2 as \"Destination__o_orderstatus\", cast(t3 as varchar) as \"Destination__o_totalprice\", "
    "st as \"Comparison Result__Comparison Status\", 'rule ' || o_orderkey % 3 as \"Transform Details__Details\" "
    f"from {PAIR_SQL}",
)
def header_promotion(spark, sf_dir):
    return rc.promote_headers(sheet_rows(spark, sf_dir))


@query(
    "section_split",
    "select o_orderkey + 2 as row_idx, s2 as source_status, cast(t3 as varchar) as destination_price, st as status, "
    f"'rule ' || o_orderkey % 3 as details from {PAIR_SQL}",
)
def section_split(spark, sf_dir):
    wide = rc.promote_headers(sheet_rows(spark, sf_dir))
    parts = rc.split_sections(wide, ["Source", "Destination", "Comparison Result", "Transform Details"])
    return parts.select(
        "row_idx",
        F.col("Source.o_orderstatus").alias("source_status"),
        F.col("Destination.o_totalprice").alias("destination_price"),
        F.col("`Comparison Result`.`Comparison Status`").alias("status"),
        F.col("`Transform Details`.Details").alias("details"),
    )


def diff_sql(keys: str, source: str) -> str:
    return " union all ".join(
        f"select {keys}, 'value' as change, '{c}' as \"column\", cast(s{i} as varchar) as source, cast(t{i} as varchar) as target "
        f"from {source} where not gone and s{i} is distinct from t{i}"
        for i, c in enumerate(COLUMNS, 1)
    ) + f" union all select {keys}, 'source_only', null, null, null from {source} where gone"


@query("cell_diff", diff_sql("o_orderkey", PAIR_SQL))
def cell_diff(spark, sf_dir):
    return rc.cell_diff(*sides(spark, sf_dir), ["o_orderkey"], COLUMNS)


@query(
    "diff_all_sheets",
    diff_sql("sheet, o_orderkey", f"(select p.*, o_orderpriority as sheet from {PAIR_SQL} p join orders using (o_orderkey))"),
)
def diff_all_sheets(spark, sf_dir):
    source, target = (s.withColumnRenamed("o_orderpriority", "sheet") for s in sides(spark, sf_dir, "o_orderpriority"))
    return rc.cell_diff(source, target, ["sheet", "o_orderkey"], COLUMNS)


WIDE_SQL = (
    "(select o_orderkey, "
    + ", ".join(
        f"case when s{i} is distinct from t{i} then s{i} end as {c}__source, "
        f"case when s{i} is distinct from t{i} then t{i} end as {c}__destination"
        for i, c in enumerate(COLUMNS, 1)
    )
    + f", st as comparison_status, 'rule ' || o_orderkey % 3 as details from {PAIR_SQL} "
    "where s1 is distinct from t1 or s2 is distinct from t2 or s3 is distinct from t3)"
)


def marked(spark, sf_dir):
    wide = rc.compare_wide(*sides(spark, sf_dir), ["o_orderkey"], COLUMNS)
    return rc.with_status(wide, status_rows(spark, sf_dir), ["o_orderkey"], "comparison_status")


@query("diff_with_status", f"select * from {WIDE_SQL} where comparison_status in ('Object Mismatch', 'Field Mismatch')")
def diff_with_status(spark, sf_dir):
    return marked(spark, sf_dir)


@query(
    "prune_pairs",
    "select o_orderkey, o_orderstatus__source, o_orderstatus__destination, o_totalprice__source, o_totalprice__destination, "
    f"comparison_status, details from {WIDE_SQL} where comparison_status = 'Field Mismatch'",
)
def prune_pairs(spark, sf_dir):
    fields = marked(spark, sf_dir).where(F.col("comparison_status") == "Field Mismatch")
    return rc.prune_empty_pairs(fields, COLUMNS)


@query(
    "diff_report_rows",
    "select 0 as section, 0 as ord, 'index|o_custkey|o_custkey|o_orderstatus|o_orderstatus|o_totalprice|o_totalprice|"
    "comparison_status|details' as line union all select 0, 1, "
    "'|source|destination|source|destination|source|destination||' union all "
    "select 1, o_orderkey + 1, concat_ws('|', cast(o_orderkey + 1 as varchar), "
    + ", ".join(f"coalesce(cast({c}__{s} as varchar), '')" for c in COLUMNS for s in ("source", "destination"))
    + f", comparison_status, details) from {WIDE_SQL} where comparison_status <> 'Match'",
)
def diff_report_rows(spark, sf_dir):
    rows = rc.report_rows(rc.prune_empty_pairs(marked(spark, sf_dir), COLUMNS), "o_orderkey", 1)
    return rows.select("section", "ord", F.array_join("cells", "|").alias("line"))


def text_sql(source: str) -> str:
    names = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey"]
    texts = ", ".join(f"coalesce(cast({c} as varchar), 'nan') as {c}" for c in names)
    return (
        "(select *, row_number() over (partition by o_custkey, o_orderstatus order by o_totalprice, o_orderkey) as position "
        f"from (select {texts} from {source}))"
    )


@query(
    "keyed_positional_diff",
    "select o_custkey, o_orderstatus, position, "
    + ", ".join(
        f"case when s.{c} is distinct from t.{c} then s.{c} end as {c}__origin, "
        f"case when s.{c} is distinct from t.{c} then t.{c} end as {c}__source"
        for c in ("o_totalprice", "o_orderkey")
    )
    + f" from {text_sql(SRC)} s full join {text_sql(TGT)} t using (o_custkey, o_orderstatus, position) "
    "where s.o_totalprice is distinct from t.o_totalprice or s.o_orderkey is distinct from t.o_orderkey",
)
def keyed_positional_diff(spark, sf_dir):
    source, target = sides(spark, sf_dir)
    order = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey"]
    extra = target.select(*order).withColumn("category_id", F.lit("x")).toDF("cust", "status", "price", "key", "category_id")
    return rc.keyed_positional_diff(source.select(*order), extra, 2, drop=["category_id"])
