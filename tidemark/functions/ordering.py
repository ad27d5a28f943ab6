"""Positions and running totals over ordered rows that no single task has to hold.

A plain window over a large key (or over no key) sorts that key's rows in one task. Here rows are
range-partitioned on ``(keys, order)``, so a hot key spreads over many partitions; each partition is
numbered on its own and then shifted by what earlier partitions hold for the same key. At most one key
per partition continues from the left, so the table of shifts has fewer rows than there are partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.session import pin, pin_measured

PART = "__part"
PLAIN_WINDOW_ROWS = 1_000_000


def spread_sort(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pinned copy of ``df`` sorted by ``(keys, order)`` over range partitions, with its partition number.

    ``(keys, order)`` should identify a row: end ``order`` with a key column, or count equal rows first.
    Rows that tie stay in one partition.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return pin(ranged).withColumn(PART, F.spark_partition_id())


def plain_running_total(df: DataFrame, order: Sequence[str], amount: Column, name: str, keys: Sequence[str]) -> DataFrame:
    """The ordinary window, for tables already measured to be small."""
    window = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(amount).over(window))


def spread_running_total(
    base: DataFrame, order: Sequence[str], amount: Column, name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``name`` to the result of ``spread_sort``: the sum of ``amount`` up to and including each row, per key."""
    keys = list(keys)
    base = base.withColumn("__amount", amount)
    per_part = base.groupBy(PART, *keys).agg(F.sum("__amount").alias("__sum"))
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        per_part.withColumn("__before", F.sum("__sum").over(earlier))
        .where(F.col("__before").isNotNull())
        .select(PART, *keys, "__before")
    )
    within = (
        Window.partitionBy(PART, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = base.withColumn("__local", F.sum("__amount").over(within))
    # fewer rows than range partitions: a fixed bound
    return (
        null_safe_join(local, shifts, [PART, *keys], bounded=True)
        .withColumn(name, F.col("__local") + F.coalesce(F.col("__before"), F.lit(0)))
        .drop(PART, "__amount", "__local", "__before")
    )


def running_total(
    df: DataFrame,
    order: Sequence[str],
    amount: Column,
    name: str,
    keys: Sequence[str] = (),
    plain_limit: int | None = None,
) -> DataFrame:
    """Running sum of ``amount`` per key over a pre-aggregated table.

    The table is written once and measured; up to ``plain_limit`` rows an ordinary window is enough,
    beyond that the rows are spread over range partitions.
    """
    pinned, rows, _ = pin_measured(df)
    if rows <= (PLAIN_WINDOW_ROWS if plain_limit is None else plain_limit):
        return plain_running_total(pinned, order, amount, name, list(keys))
    return spread_running_total(spread_sort(pinned, keys, order), order, amount, name, keys)


def row_position(
    df: DataFrame, order: Sequence[str], name: str = "row_idx", keys: Sequence[str] = (), start: int = 1
) -> DataFrame:
    """Number the rows of each key (or of the whole table) from ``start`` in the given order."""
    one = F.lit(1).cast("bigint")
    numbered = spread_running_total(spread_sort(df, keys, order), order, one, name, keys)
    return numbered if start == 1 else numbered.withColumn(name, F.col(name) + F.lit(start - 1))


EXPAND_BLOCK = 10_000


def expand_counts(df: DataFrame, first: Column, count: Column, name: str) -> DataFrame:
    """Repeat each row ``count`` times with ``name`` running from ``first``.

    Large counts unfold in two steps, with the blocks dealt out to all tasks in between.
    """
    numbered = df.withColumns({"__first": first, "__count": count})
    wide = numbered.where(F.col("__count") > EXPAND_BLOCK)
    blocks = (
        wide.withColumn("__b", F.explode(F.sequence(F.lit(0), ((F.col("__count") - 1) / EXPAND_BLOCK).cast("bigint"))))
        .repartition("__first", "__b", *[c for c in df.columns])
        .withColumn("__count", F.least(F.col("__count") - F.col("__b") * EXPAND_BLOCK, F.lit(EXPAND_BLOCK)))
        .withColumn("__first", F.col("__first") + F.col("__b") * EXPAND_BLOCK)
        .drop("__b")
    )
    small = numbered.where(F.col("__count") <= EXPAND_BLOCK)
    return (
        small.unionByName(blocks)
        .withColumn(name, F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__count") - 1)))
        .drop("__first", "__count")
    )
