"""Exact quantiles without a per-group buffer.

Quantiles of whole columns are found by selection: sketches bracket the wanted ranks, and only the values inside are counted
one by one. For groups, the built-in ``percentile`` keeps every distinct value in one task; here values are counted
first (combined before the shuffle), the distinct values are ranked by spread-out running totals, and
only the two order statistics around each requested position are kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tidemark.functions import ordering
from tidemark.functions.joins import null_safe_join
from tidemark.session import pin_measured


BRACKET_ACCURACY = 10_000
FEW = 12  # up to here the rank test is unrolled into generated code


def _probs(probs: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(p)) for p in probs])


def _holds_wanted_rank(probs: Sequence[float], method: str) -> Column:
    """True for the few value cells in which a requested order statistic lies."""

    def test(p: Column) -> Column:
        position = p * (F.col("n") - 1)
        first = F.round(position) if method == "nearest" else F.floor(position)
        last = first if method == "nearest" else F.ceil(position)
        return (last >= F.col("__hi") - F.col("__c")) & (first < F.col("__hi"))

    if len(probs) <= FEW:
        return reduce(or_, [test(F.lit(float(p))) for p in probs])
    return F.exists(_probs(probs), test)


def _wanted_ranks(probs: Sequence[float], method: str) -> Column:
    """Array of (probability index, 0-based rank, weight) for the group size in column ``n``."""

    def lower_and_upper(p: Column, i: Column) -> Column:
        position = p * (F.col("n") - 1)
        if method == "nearest":
            return F.array(_rank(i, F.round(position), F.lit(1.0)))
        low = F.floor(position)
        share = position - low
        return F.array(_rank(i, low, 1 - share), _rank(i, low + 1, share))

    return F.flatten(F.transform(_probs(probs), lower_and_upper))


def _rank(i: Column, rank: Column, weight: Column) -> Column:
    return F.struct(i.alias("i"), rank.cast("bigint").alias("rank"), weight.alias("w"))


def _ranked_cells(
    cells: DataFrame, by: list[str], probs: Sequence[float], method: str, plain_limit: int | None = None
) -> DataFrame:
    """Value cells around the wanted ranks, with the count up to and including each (``__hi``) and the group size ``n``.

    A small measured table takes an ordinary window. A larger one is range-partitioned; the totals per
    partition already tell which partitions hold a wanted rank, and only those are ranked.
    """
    pinned, rows, _ = pin_measured(cells)
    if rows <= (ordering.PLAIN_WINDOW_ROWS if plain_limit is None else plain_limit):
        ranked = ordering.plain_running_total(pinned, ["__v"], F.col("__c"), "__hi", by)
        return ranked.withColumn("n", F.sum("__c").over(Window.partitionBy(*(by or [F.lit(0)]))))
    spread = ordering.spread_sort(pinned, by, ["__v"])
    keys = [ordering.PART, *by]
    group = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = group.orderBy(ordering.PART).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        spread.groupBy(*keys)
        .agg(F.sum("__c").alias("__c"))
        .withColumns({"__before": F.coalesce(F.sum("__c").over(earlier), F.lit(0)), "n": F.sum("__c").over(group)})
        .withColumn("__hi", F.col("__before") + F.col("__c"))
        .where(_holds_wanted_rank(probs, method))
        .select(*keys, "__before", "n")
    )
    within = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # without groups there is at most one row per partition
    joined = null_safe_join(spread, placed, keys, "inner", bounded=not by)
    return joined.withColumn("__hi", F.sum("__c").over(within) + F.col("__before"))


def quantile_rows(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), method: str = "linear"
) -> DataFrame:
    """Long form: one row ``(*by, prob_idx, n, quantile)`` per group and probability.

    ``method`` is ``linear`` (between the neighbouring values) or ``nearest``. Nulls and NaN are ignored.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"unknown quantile method: {method}")
    by = list(by)
    cells = (
        df.select(*[F.col(f"`{b}`") for b in by], F.col(f"`{value}`").cast("double").alias("__v"))
        .where(F.col("__v").isNotNull() & ~F.isnan("__v"))
        .groupBy(*by, "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    sized = _ranked_cells(cells, by, probs, method)
    hits = F.filter(
        _wanted_ranks(probs, method),
        lambda r: (r["rank"] >= F.col("__hi") - F.col("__c")) & (r["rank"] < F.col("__hi")) & (r["w"] > 0),
    )
    return (
        sized.where(_holds_wanted_rank(probs, method))
        .select(*by, "n", "__v", F.explode(hits).alias("hit"))
        .groupBy(*by, F.col("hit.i").alias("prob_idx"))
        .agg(F.max("n").alias("n"), F.sum(F.col("hit.w") * F.col("__v")).alias("quantile"))
    )


def approx_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """Sketch-based quantiles with rank error up to ``1/accuracy``: one pass, no sort, bounded state."""
    names = list(names) if names else [f"q{p:g}".replace(".", "_") for p in probs]
    x = F.col(f"`{value}`").cast("double")
    sketch = F.percentile_approx(F.when(~F.isnan(x), x), [float(p) for p in probs], accuracy)
    return df.groupBy(*by).agg(sketch.alias("__q")).select(*by, *[F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(names)])


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    method: str = "linear",
) -> DataFrame:
    """Wide form: one row per group with a column per probability. Groups without values are absent;
    without ``by`` there is always exactly one row."""
    names = list(names) if names else [f"q{p:g}".replace(".", "_") for p in probs]
    if not by and method == "linear":
        return selected_quantiles(df, [value], probs, names).agg(*[F.max(n).alias(n) for n in names])
    rows = quantile_rows(df, value, probs, by, method)
    picks = [F.max(F.when(F.col("prob_idx") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)]
    return rows.groupBy(*by).agg(*picks)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of several numeric columns: ``(*by, column, *names)``; columns without values are absent.

    Without groups by selection (``selected_quantiles``). With groups rows unfold by column number, which hashes and sorts cheaper
    than the column's name.
    """
    if not by:
        return selected_quantiles(df, columns, probs, names)
    numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    tall = df.select(*by, F.posexplode(numbers).alias("__i", "__value"))
    found = quantiles(tall, "__value", probs, [*by, "__i"], names)
    label = F.get(F.array(*[F.lit(c) for c in columns]), F.col("__i"))
    return found.select(*by, label.alias("column"), *names)


@dataclass
class Bracket:
    """A closed range of one column's values that holds wanted ranks, given as (rank, probability number, weight)."""

    column: int
    low: float
    high: float
    wanted: list[tuple[int, int, float]]
    below: int = 0

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))


def selected_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str], accuracy: int = BRACKET_ACCURACY
) -> DataFrame:
    """Exact linear quantiles of whole columns by selection.

    A first aggregate of mergeable sketches brackets every wanted rank, a second one counts the rows below and inside each bracket and finds the next value
    above it; only the values inside, some 4 / ``accuracy`` of a column, are counted one by one and ranked. A bracket that
    missed its ranks (a sketch promises its error, but not more) is widened to all values of its column.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    values = [F.when(~F.isnan(x), x) for x in numbers]
    margin = 2 / accuracy
    edges = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-margin, margin)]
    sketched = df.agg(*[
        F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.percentile_approx(v, edges, accuracy).alias("edges")).alias(f"c{i}")
        for i, v in enumerate(values)
    ]).first()
    brackets = [b for i, facts in enumerate(sketched) if facts["n"] for b in brackets_of(i, facts, probs, margin)]
    spark = df.sparkSession
    if not brackets:
        return spark.createDataFrame([], ", ".join(["column string", *[f"`{n}` double" for n in names]]))

    def measured(asked: Sequence[Bracket]) -> list:
        row = df.agg(*[
            F.struct(
                F.count_if(values[b.column] < F.lit(b.low)).alias("below"), F.count_if(b.holds(values[b.column])).alias("inside"),
                F.min(F.when(values[b.column] > F.lit(b.high), values[b.column])).alias("next"),
            ).alias(f"b{k}") for k, b in enumerate(asked)
        ]).first()
        return list(row)

    following: dict[int, float] = {}
    for k, (b, facts) in enumerate(zip(brackets, measured(brackets))):
        b.below = facts["below"]
        ranks = [rank for rank, _, _ in b.wanted]
        end = b.below + facts["inside"]
        if min(ranks) < b.below or max(ranks) > end or (max(ranks) == end and facts["next"] is None):
            b.low, b.high, b.below = sketched[b.column]["low"], sketched[b.column]["high"], 0
        elif max(ranks) == end:
            following[k] = facts["next"]
    hits = F.array_compact(F.array(*[
        F.when(b.holds(values[b.column]), F.struct(F.lit(k).alias("k"), values[b.column].alias("v"))) for k, b in enumerate(brackets)
    ]))
    cells = df.select(F.explode(hits).alias("hit")).groupBy("hit.k", "hit.v").agg(F.count(F.lit(1)).alias("c"))
    if following:
        cells = cells.unionByName(spark.createDataFrame([(k, v, 1) for k, v in following.items()], "k int, v double, c bigint"))
    ranked = ordering.running_total(cells, ["v"], F.col("c"), "hi", ["k"])
    wanted = [(k, b.column, j, rank - b.below, weight) for k, b in enumerate(brackets) for rank, j, weight in b.wanted]
    asked = F.broadcast(spark.createDataFrame(wanted, "k int, i int, j int, rank bigint, w double"))  # two rows per column and probability
    found = ranked.join(asked, "k").where((F.col("rank") >= F.col("hi") - F.col("c")) & (F.col("rank") < F.col("hi")))
    one = found.groupBy("i", "j").agg(F.sum(F.col("w") * F.col("v")).alias("q"))
    label = F.get(F.array(*[F.lit(c) for c in columns]), F.col("i"))
    picks = [F.max(F.when(F.col("j") == j, F.col("q"))).alias(n) for j, n in enumerate(names)]
    return one.groupBy("i").agg(*picks).select(label.alias("column"), *names)


def brackets_of(column: int, facts: Row, probs: Sequence[float], margin: float) -> list[Bracket]:
    """Disjoint brackets of one column's wanted ranks."""
    out: list[Bracket] = []
    single = []
    for j, p in enumerate(probs):
        position = p * (facts["n"] - 1)
        low = math.floor(position)
        share = position - low
        wanted = [(low, j, 1 - share)] + ([(low + 1, j, share)] if share > 0 else [])
        begin = facts["low"] if p <= margin else facts["edges"][2 * j]
        end = facts["high"] if p >= 1 - margin else facts["edges"][2 * j + 1]
        single.append((begin, end, wanted))
    for begin, end, wanted in sorted(single, key=lambda b: b[:2]):
        if out and begin <= out[-1].high:
            out[-1].high = max(out[-1].high, end)
            out[-1].wanted += wanted
        else:
            out.append(Bracket(column, begin, end, list(wanted)))
    return out
