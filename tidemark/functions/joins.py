"""Joins against summary tables whose size is measured before they are broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import pin_measured

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, size: int | None = None) -> DataFrame:
    """Materialise a summary table and mark it for broadcast when its measured size is below ``limit``.

    A larger one is left to Spark, which shuffles both sides and splits skewed partitions (adaptive skew
    join). Either way the table is computed once.
    """
    if size is None:
        df, _, size = pin_measured(df)
    return F.broadcast(df) if size <= limit else df


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", bounded: bool = False,
    size: int | None = None,
) -> DataFrame:
    """Equi-join in which null keys match each other, as group keys do. Key columns come from ``left``.

    ``right`` is a summary with one row per key. Its size is measured before it is broadcast, unless the
    caller knows a bound (``bounded``) or has measured it (``size``).
    """
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`") for c in right.columns if c not in keys],
    )
    renamed = F.broadcast(renamed) if bounded else broadcast_if_small(renamed, size=size)
    condition: Column = reduce(
        and_, [left[f"`{k}`"].eqNullSafe(renamed[f"__r_{i}"]) for i, k in enumerate(keys)]
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{i}" for i in range(len(keys))])
