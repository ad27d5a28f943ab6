import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import ordering as od
from tidemark.functions.joins import null_safe_join


def hot_frame(spark, n=3000):
    """Two thirds of the rows share one key, one key is null."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        (F.col("id") % 5).alias("v"),
    )


def test_running_total_matches_pandas(spark, window_mode):
    df = hot_frame(spark)
    got = od.running_total(df, ["id"], F.col("v"), "total", ["k"]).toPandas().sort_values("id").reset_index(drop=True)
    want = df.toPandas().sort_values("id").reset_index(drop=True)
    want["total"] = want.groupby("k", dropna=False)["v"].cumsum()
    pd.testing.assert_frame_equal(got[["id", "v", "total"]], want[["id", "v", "total"]], check_dtype=False)


def test_running_total_without_key(spark, window_mode):
    got = od.running_total(spark.range(1000), ["id"], F.lit(1), "n").toPandas()
    assert (got["n"] == got["id"] + 1).all()


def test_hot_key_spreads_over_partitions(spark, many_partitions):
    parts = od.spread_sort(hot_frame(spark, 20000), ["k"], ["id"])
    hot = parts.where("k = 'hot'").select(od.PART).distinct().count()
    assert hot > 2


def test_row_position_per_key(spark, many_partitions):
    got = od.row_position(hot_frame(spark), ["id"], "pos", ["k"]).toPandas().sort_values("id")
    want = got.groupby("k", dropna=False).cumcount() + 1
    assert (got["pos"].values == want.values).all()


def test_row_position_start(spark):
    assert sorted(r["p"] for r in od.row_position(spark.range(5), ["id"], "p", start=0).collect()) == [0, 1, 2, 3, 4]


def test_expand_counts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(od, "EXPAND_BLOCK", 10)
    df = spark.createDataFrame([("a", 1, 3), ("b", 4, 37)], "k string, lo long, n long")
    rows = od.expand_counts(df, F.col("lo"), F.col("n"), "pos").select("k", "pos").collect()
    assert sorted((r["k"], r["pos"]) for r in rows) == [("a", i) for i in (1, 2, 3)] + [("b", i) for i in range(4, 41)]


def test_null_safe_join_matches_null_keys_and_falls_back(spark, monkeypatch):
    from tidemark.functions import joins

    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    want = {(1, 10), (2, 20), (3, None)}
    assert {(r["x"], r["y"]) for r in null_safe_join(left, right, ["k"]).collect()} == want
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (0, None))
    joined = null_safe_join(left, right, ["k"])
    assert {(r["x"], r["y"]) for r in joined.collect()} == want
    assert "hint" not in joined._jdf.queryExecution().logical().toString().lower()
