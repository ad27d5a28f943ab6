"""The paths for large data must give the same results: no ordinary window, no broadcast, no merged partitions."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_queries import TABLES, normal
from tidemark.functions import joins, ordering

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "describe_all", "stat_block_by_group", "qq_points", "group_median_on_rows", "drop_vs_impute", "compare_groupings",
    "auc_by_ranks", "window_sum_rownum", "keyed_positional_diff", "sample_labels", "error_summary", "mark_duplicates", "star_model",
    "numbered_lines",
]


@pytest.fixture
def large_data_paths(spark, monkeypatch, many_partitions):
    monkeypatch.setattr(ordering, "PLAIN_WINDOW_ROWS", 0)
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (0, None))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, large_data_paths, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    frame = queries()[name](spark, SF_DIR)
    columns, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    reference = con.execute(oracle_sql()[name])
    assert (columns, got) == normal([d[0] for d in reference.description], reference.fetchall())


def test_hot_key_is_split_in_a_shuffled_join(spark, monkeypatch):
    """Without a broadcast, a key with a third of the rows is dealt out to several tasks."""
    from pyspark.sql import functions as F

    from tidemark.operators.aggregates import group_total_on_rows

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (0, None))
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(400_000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(1.0).alias("x")
        )
        out = group_total_on_rows(df, "k", "x", "total")
        assert out.agg(F.max("total")).first()[0] == df.where("k = 0").count()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
