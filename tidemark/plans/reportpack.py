"""Validation-report summary over orders with rule-made comments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import report as rp
from tidemark.plans.registry import query, table
from tidemark.session import scratch_path

IDS = ["o_orderkey", "o_custkey", "o_orderstatus"]


def comments(spark, sf_dir):
    key = F.col("o_orderkey")
    two = F.concat(F.lit("E1_Format_"), F.col("o_orderstatus"))
    second = F.concat(F.lit("\nE2_Range_"), F.col("o_orderpriority"))
    comment = F.when(key % 97 == 0, "plain").otherwise(F.concat(two, F.when(key % 2 == 0, second).otherwise("")))
    status = F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, "Failed").otherwise("Warning")
    return table(spark, sf_dir, "orders").select(
        *IDS, F.col("o_orderpriority").alias("sheet"), comment.alias("comment"), status.alias("status")
    )


COMMENT_SQL = (
    "(select o_orderkey, o_custkey, o_orderstatus, o_orderpriority as sheet, case when o_orderkey % 97 = 0 then 'plain' else "
    "'E1_Format_' || o_orderstatus || case when o_orderkey % 2 = 0 then chr(10) || 'E2_Range_' || o_orderpriority else '' end "
    "end as comment, case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then 'Failed' else 'Warning' end as status, "
    "row_number() over (partition by o_orderpriority order by o_orderkey, o_custkey, o_orderstatus) + 1 as report_index from orders)"
)
SAMPLE_SQL = (
    "'o_orderkey: ' || o_orderkey || ' - o_custkey: ' || o_custkey || ' - o_orderstatus: ' || o_orderstatus || "
    "'(Report index: ' || report_index || ')'"
)
LINES_SQL = (
    f"(select *, {SAMPLE_SQL} as sample, coalesce(string_split(line, '_')[2], '') as error_type, "
    "coalesce(string_split(line, '_')[3], '') as message from (select *, unnest(string_split(comment, chr(10))) as line, "
    f"generate_subscripts(string_split(comment, chr(10)), 1)::int - 1 as line_no from {COMMENT_SQL}))"
)


def labelled_comments(spark, sf_dir):
    return rp.sample_labels(comments(spark, sf_dir), IDS, ["sheet"])


@query("sample_labels", f"select sheet, o_orderkey, report_index, {SAMPLE_SQL} as sample from {COMMENT_SQL}")
def sample_labels(spark, sf_dir):
    return labelled_comments(spark, sf_dir).select("sheet", "o_orderkey", "report_index", "sample")


@query("split_error_messages", f"select o_orderkey, line_no, error_type, message from {LINES_SQL}")
def split_error_messages(spark, sf_dir):
    return rp.split_messages(comments(spark, sf_dir), "comment").select("o_orderkey", "line_no", "error_type", "message")


def summary_sql(keys: str, shown: str, message: str, source: str) -> str:
    return (
        f"with r as (select *, {message} as msg, row_number() over (partition by {keys} order by report_index, line_no, sheet) "
        f"as rn from {source} where status is not null) select {shown}, count(*) as amount, "
        "string_agg(sample, chr(10) order by rn) filter (rn <= 5) as samples "
        f"from r group by {keys}"
    )


@query("error_summary", summary_sql("sheet, message, status, error_type", "sheet, error_type, message", "message", LINES_SQL))
def error_summary(spark, sf_dir):
    lines = rp.split_messages(labelled_comments(spark, sf_dir), "comment", "Pre")
    return rp.summarise(lines, "status", ["sheet"], "Pre")


@query("error_summary_post", summary_sql("sheet, line, status", "sheet, status, line as message", "line", LINES_SQL))
def error_summary_post(spark, sf_dir):
    lines = rp.split_messages(labelled_comments(spark, sf_dir), "comment", "Post")
    return rp.summarise(lines, "status", ["sheet"], "Post")


@query(
    "summary_per_sheet",
    "select sheet, count(*) as lines, sum(amount)::bigint as amount from ("
    + summary_sql("sheet, message, status, error_type", "sheet, error_type, message", "message", LINES_SQL)
    + ") group by sheet",
)
def summary_per_sheet(spark, sf_dir):
    """One folder per sheet, read back."""
    path = scratch_path(spark, "summary")
    error_summary(spark, sf_dir).write.partitionBy("sheet").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("sheet").agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount"))


@query(
    "comment_occurrences",
    "select line, o_orderkey || ' - ' || report_index as final_id, count(*) over (partition by line) as amount "
    f"from {LINES_SQL}",
)
def comment_occurrences(spark, sf_dir):
    return rp.occurrences(labelled_comments(spark, sf_dir), "o_orderkey", "comment")
