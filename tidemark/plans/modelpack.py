"""Models on the table with derived gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import models as md
from tidemark.plans.registry import DN_SQL, derived_nulls, query, rounded, table

FEATURES = ["qty", "l_discount", "l_tax", "p_size", "p_retailprice"]


def frame(spark, sf_dir):
    return derived_nulls(spark, sf_dir).select("l_orderkey", *FEATURES, "price")


@query(
    "modelling_frame",
    f"select count(*) as rows, round(sum(price), 2) as target, count(qty) as qty, count(p_size) as p_size from {DN_SQL} "
    "where price is not null",
)
def modelling_frame(spark, sf_dir):
    wide = derived_nulls(spark, sf_dir).select(
        "l_orderkey", "qty", "p_size", "p_name", "price", F.lit(1.0).alias("fixed"),
        F.when(F.col("l_orderkey") % 4 == 0, F.col("qty")).alias("rare"),
    )
    kept = md.modelling_frame(wide, "price", ["l_orderkey"])
    assert "fixed" not in kept.columns and "rare" not in kept.columns and "p_name" not in kept.columns
    return kept.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 2).alias("target"), F.count("qty").alias("qty"),
        F.count("p_size").alias("p_size"),
    )


@query(
    "hash_split",
    "select l_orderkey % 5 = 0 as is_test, count(*) as rows, round(avg(l_quantity), 6) as mean from lineitem group by 1",
)
def hash_split(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .select(md.is_test(F.col("l_orderkey")).alias("is_test"), "l_quantity")
        .groupBy("is_test")
        .agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("l_quantity"), 6).alias("mean"))
    )


@query(
    "regression_metrics",
    "with e as (select l_extendedprice as y, l_quantity * 2000 as p, avg(l_extendedprice) over () as m from lineitem) select "
    "round(avg(abs(y - p)), 4) as mae, round(sqrt(avg(power(y - p, 2))), 4) as rmse, "
    "round(1 - sum(power(y - p, 2)) / sum(power(y - m, 2)), 8) as r2 from e",
)
def regression_metrics(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("p", F.col("l_quantity") * 2000)
    return rounded(rounded(md.regression_metrics(lines, "l_extendedprice", "p"), 4, "mae", "rmse"), 8, "r2")


@query("impute_model_grid")
def impute_model_grid(spark, sf_dir):
    return md.impute_model_grid(frame(spark, sf_dir), "price", "l_orderkey", rounds=2)


@query("mice_impute")
def mice_impute(spark, sf_dir):
    dn = derived_nulls(spark, sf_dir).select(*[F.col(c).cast("double").alias(c) for c in [*FEATURES, "price"]])
    filled = md.mice_impute(dn, [*FEATURES, "price"], rounds=3)
    return filled.agg(
        F.count("qty").alias("qty"), F.count("price").alias("price"), F.avg("qty").alias("qty_mean"), F.avg("price").alias("price_mean")
    )


LINE_SQL = "(select regr_slope(price, l_quantity) as b, regr_intercept(price, l_quantity) as a from {dn} where price is not null)".format(dn=DN_SQL)


def one_feature(spark, sf_dir):
    return derived_nulls(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "price", "l_extendedprice")


@query(
    "mice_one_gap",
    "select count(filled) as rows, round(avg(filled), 2) as mean from (select coalesce(price, a + b * l_quantity) as filled "
    f"from {DN_SQL}, {LINE_SQL})",
)
def mice_one_gap(spark, sf_dir):
    """With one column to fill, the chain is a single regression."""
    data = derived_nulls(spark, sf_dir).select("price", "l_quantity")
    return md.mice_impute(data, ["price", "l_quantity"], rounds=3).agg(
        F.count("price").alias("rows"), F.round(F.avg("price"), 2).alias("mean")
    )


@query(
    "predict_missing",
    f"select count(*) as predicted, round(avg(a + b * l_quantity), 2) as mean from {DN_SQL}, {LINE_SQL} where price is null",
)
def predict_missing(spark, sf_dir):
    guessed = md.predict_missing(one_feature(spark, sf_dir), "price", ["l_quantity"])
    return guessed.agg(F.count(F.lit(1)).alias("predicted"), F.round(F.avg("prediction"), 2).alias("mean"))


@query(
    "predict_write_back",
    f"select count(filled) as rows, round(sum(filled) / count(*), 2) as mean from (select coalesce(price, a + b * l_quantity) as filled from {DN_SQL}, {LINE_SQL})",
)
def predict_write_back(spark, sf_dir):
    filled = md.predict_missing(one_feature(spark, sf_dir), "price", ["l_quantity"], write_back=True)
    return filled.agg(F.count("price").alias("rows"), F.round(F.avg("price"), 2).alias("mean"))


@query(
    "prediction_shift",
    "with p as (select a + b * l_quantity as x, (select avg(price) from {dn}) as y from {dn}, {line} where price is null), "
    "t as (select 'a' as c, x as v from p union all select 'b', y from p union all select 'difference', y - x from p) "
    "select c as \"column\", round(median(v), 1) as median, round(avg(v), 1) as mean from t group by c".replace(
        "{dn}", DN_SQL
    ).replace("{line}", LINE_SQL),
)
def prediction_shift(spark, sf_dir):
    """A fitted line against the plain mean as predictions for the missing prices."""
    data = one_feature(spark, sf_dir)
    mean = data.agg(F.avg("price").alias("m")).scalar()
    guessed = md.predict_missing(data, "price", ["l_quantity"]).withColumn("baseline", mean)
    return rounded(md.prediction_shift(guessed, "prediction", "baseline"), 1, "median", "mean")


@query(
    "residual_top20",
    "select l_orderkey, l_linenumber, round(abs(l_extendedprice - (a + b * l_quantity)), 1) as abs_error from "
    f"{DN_SQL}, {LINE_SQL} where price is null order by abs(l_extendedprice - (a + b * l_quantity)) desc, l_orderkey, l_linenumber limit 20",
)
def residual_top20(spark, sf_dir):
    """Predictions for the hidden prices against their true values."""
    guessed = md.predict_missing(one_feature(spark, sf_dir), "price", ["l_quantity"])
    top = md.residual_top(guessed, "l_extendedprice", "prediction", 20, ["l_orderkey", "l_linenumber"])
    return rounded(top.select("l_orderkey", "l_linenumber", "abs_error"), 1, "abs_error")


@query(
    "residual_histogram",
    "with r as (select l_extendedprice - 2000 * l_quantity as e from lineitem), s as (select min(e) as lo, max(e) as hi from r) "
    "select least(cast(floor((e - lo) / ((hi - lo) / 50)) as int), 49) as bin, count(*) as count from r, s group by 1",
)
def residual_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("p", 2000 * F.col("l_quantity"))
    return md.residual_histogram(lines, "l_extendedprice", "p").drop("left")


@query("mice_evidence")
def mice_evidence(spark, sf_dir):
    """Errors of the hidden prices and quantities, filled by least squares and by penalties of largest evidence."""
    data = derived_nulls(spark, sf_dir).select(
        *[F.col(c).cast("double").alias(c) for c in [*FEATURES, "price"]], F.col("l_extendedprice").cast("double").alias("was"),
        F.col("l_quantity").cast("double").alias("had"),
    )
    out = None
    for name, ridge in (("least_squares", 0.0), ("evidence", "evidence")):
        filled = md.mice_impute(data.withColumn("hidden", F.col("price").isNull()), [*FEATURES, "price"], rounds=5, ridge=ridge)
        errors = filled.agg(
            F.lit(name).alias("ridge"), F.avg(F.when(F.col("hidden"), F.abs(F.col("price") - F.col("was")))).alias("price_error"),
            F.avg(F.abs(F.col("qty") - F.col("had"))).alias("qty_error"), F.count("price").alias("rows"),
        )
        out = errors if out is None else out.unionByName(errors)
    return out
