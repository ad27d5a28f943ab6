"""Named queries over a folder of parquet tables, each with its plain-SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


QTY_RULE = (
    "case when l_quantity >= 45 or (p_brand = 'Brand#9' and p_type = 'ECONOMY') then null else l_quantity end"
)
PRICE_RULE = "case when l_orderkey % 37 = 0 or l_quantity >= 48 then null else l_extendedprice end"
DN_SQL = f"(select *, {QTY_RULE} as qty, {PRICE_RULE} as price from lineitem join part on l_partkey = p_partkey)"


def derived_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part, with rule-made gaps in ``qty`` and ``price`` and one group without ``qty``."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    # by merging: a small file may hold more rows than the driver should collect for a broadcast
    return lineitem.join(part.hint("merge"), F.col("l_partkey") == F.col("p_partkey")).select(
        "*", F.expr(QTY_RULE).alias("qty"), F.expr(PRICE_RULE).alias("price")
    )


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})
