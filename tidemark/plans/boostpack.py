"""Boosting that keeps missing values, on the table with derived gaps and a target made from what the gaps hide."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boosting as bo, models as md
from tidemark.plans.registry import DN_SQL, derived_nulls, query
from tidemark.session import pin_columns

FEATURES = ["qty", "l_discount", "l_tax", "p_size"]
TARGET = "l_quantity * 100 + case when p_size > 25 then 900 else 0 end + l_discount * 10000 * case when l_tax > 0.04 then 1 else -1 end"


def rows(spark, sf_dir):
    return derived_nulls(spark, sf_dir).select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in FEATURES], F.expr(TARGET).cast("double").alias("y"))


@query("boosted_missing")
def boosted_missing(spark, sf_dir):
    """Held-out errors of boosting with a learned direction for gaps, by level and by best leaf, and of Spark's own trees on filled gaps."""
    frame = pin_columns(rows(spark, sf_dir))
    test = md.is_test(F.col("l_orderkey"))
    train, held_out = frame.where(~test), frame.where(test)
    binned = bo.binned_cells(train, FEATURES, "y")
    out = []
    for name, options in (("by_level", {}), ("by_leaf", {"max_leaves": 12, "depth": 6})):
        model = bo.fit_boosted(train, FEATURES, "y", trees=6, learning_rate=0.5, binned=binned, **{"depth": 4, **options})
        scores = md.regression_metrics(bo.with_prediction(held_out, model), "y", "prediction")
        out.append(scores.select(F.lit(name).alias("model"), "mae", "rmse", "r2"))
    filled = md.fill(frame, md.column_fill(train, FEATURES, "median"))
    fitted = md.fit_model(filled.where(~test), FEATURES, "y", "boosting")
    scores = md.regression_metrics(fitted.transform(filled.where(test)), "y", "prediction")
    out.append(scores.select(F.lit("median_and_trees").alias("model"), "mae", "rmse", "r2"))
    return out[0].unionByName(out[1]).unionByName(out[2])


SPLIT_SQL = f"""
with t as (
    select qty::double as qty, l_discount::double as l_discount, l_tax::double as l_tax, p_size::double as p_size, ({TARGET})::double as y
    from {DN_SQL}
), centred as (select *, y - avg(y) over () as d from t),
long as (
    select 0 as f, qty as x, d from centred union all select 1, l_discount, d from centred
    union all select 2, l_tax, d from centred union all select 3, p_size, d from centred
), cells as (select f, x, sum(d) as g, count(*) as n from long group by f, x),
missing as (select f, coalesce(sum(g) filter (x is null), 0) as gm, coalesce(sum(n) filter (x is null), 0) as nm, sum(g) as gt, sum(n) as nt from cells group by f),
cuts as (
    select f, x, sum(g) over (partition by f order by x) as gl, sum(n) over (partition by f order by x) as nl from cells where x is not null
), sides as (
    select c.f, x, true as missing_left, gl + gm as gl, nl + nm as nl, gt, nt from cuts c join missing using (f)
    union all select c.f, x, false, gl, nl, gt, nt from cuts c join missing using (f) where nm > 0
), gains as (
    select *, gl * gl / (nl + 1) + (gt - gl) * (gt - gl) / (nt - nl + 1) - gt * gt / (nt + 1) as gain from sides where nt > nl
)
select ['qty', 'l_discount', 'l_tax', 'p_size'][f + 1] as feature, round(x, 6) as edge, missing_left, round(gain / 1e6, 3) as gain_millions,
    nl::bigint as left_rows, (nt - nl)::bigint as right_rows, round(gl / (nl + 1), 4) as left_value, round((gt - gl) / (nt - nl + 1), 4) as right_value
from gains order by gain desc limit 1
"""


@query("boosted_first_split", SPLIT_SQL)
def boosted_first_split(spark, sf_dir):
    """The first cut of a tree with bins for all distinct values: feature, edge, side of the gaps, gain and the two leaves."""
    model = bo.fit_boosted(rows(spark, sf_dir), FEATURES, "y", trees=1, depth=1, learning_rate=1.0, max_bins=2048)
    root, left, right = model.trees[0]
    found = (
        model.features[root.feature], round(root.edge, 6), root.missing_left, round(root.gain / 1e6, 3), left.rows, right.rows,
        round(left.value, 4), round(right.value, 4),
    )
    schema = "feature string, edge double, missing_left boolean, gain_millions double, left_rows bigint, right_rows bigint, left_value double, right_value double"
    return spark.createDataFrame([found], schema)
