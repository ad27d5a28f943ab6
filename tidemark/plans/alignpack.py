"""Two ordered copies of a table without a key: rows left out, altered, added and moved by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.ordering import row_position
from tidemark.operators import alignment as al
from tidemark.plans.registry import query, table

COLUMNS = ["o_custkey", "o_totalprice", "o_orderdate"]

SIDES_SQL = """
with numbered as (
    select row_number() over (order by o_orderkey) as rn, o_custkey, o_totalprice, o_orderdate from orders
), loaded as (
    select rn * 10 + case when rn % 100 = 70 then 1e12 else 0 end as spot, rn, case when rn % 100 = 30 then 'changed' when rn % 100 = 70 then 'moved' else 'equal' end as status
    from numbered where rn % 100 <> 10
    union all select rn * 10 + 5, null, 'inserted' from numbered where rn % 100 = 50
), placed as (select *, row_number() over (order by spot) as right_pos from loaded),
found as (
    select status, rn as left_pos, right_pos from placed union all select 'deleted', rn, null from numbered where rn % 100 = 10
)
"""


def sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *COLUMNS)
    left = row_position(orders, ["o_orderkey"], "rn").withColumn("at", F.col("rn").cast("double") * 10)
    kind = F.col("rn") % 100
    later = F.when(kind == 70, F.lit(1e12)).otherwise(F.lit(0.0))
    altered = F.when(kind == 30, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast(left.schema["o_totalprice"].dataType)
    kept = left.where(kind != 10).withColumns({"at": F.col("at") + later, "o_totalprice": altered})
    added = left.where(kind == 50).withColumns({"at": F.col("at") + 5, "o_custkey": -F.col("rn").cast(left.schema["o_custkey"].dataType)})
    return left.select("at", *COLUMNS), kept.select("at", *COLUMNS).unionByName(added.select("at", *COLUMNS))


@query(
    "align_rows",
    SIDES_SQL + "select status, count(*) as rows, sum(left_pos)::bigint as left_sum, sum(right_pos)::bigint as right_sum from found group by status",
)
def align_rows(spark, sf_dir):
    """How many rows are equal, changed, moved, deleted or inserted, and where."""
    found = al.align_rows(*sides(spark, sf_dir), ["at"], COLUMNS)
    return found.groupBy("status").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("left_pos").alias("left_sum"), F.sum("right_pos").alias("right_sum")
    )


@query(
    "aligned_cells",
    SIDES_SQL + "select status, left_pos, right_pos, case status when 'changed' then 'o_totalprice' end as \"column\" from found where status <> 'equal'",
)
def aligned_cells(spark, sf_dir):
    """The differing cells of changed rows, and the rows that stand on one side or elsewhere."""
    return al.aligned_cells(*sides(spark, sf_dir), ["at"], COLUMNS).select("status", "left_pos", "right_pos", "column")
