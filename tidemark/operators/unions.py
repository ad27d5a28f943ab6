"""Stacking tables by column name, with strict or widened types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Fixed order of numeric types, narrowest first.
NUMERIC_ORDER = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def merged_type(kinds: set[str]) -> str:
    """The type all of ``kinds`` fit in: the same type, the widest number, else text."""
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= set(NUMERIC_ORDER):
        widest = max(kinds, key=NUMERIC_ORDER.index)
        return "double" if widest == "float" and kinds & {"int", "bigint"} else widest
    return "string"


def column_types(frames: Sequence[DataFrame]) -> dict[str, set[str]]:
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if not isinstance(field.dataType, T.NullType):
                kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
            else:
                kinds.setdefault(field.name, set())
    return kinds


def diagonal_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns null; the same column must have the same type everywhere."""
    clashes = {c: sorted(k) for c, k in column_types(frames).items() if len(k) > 1}
    if clashes:
        raise TypeError(f"column types differ between inputs: {clashes}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def relaxed_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name in which clashing types are widened first."""
    target = {c: merged_type(k) if k else "string" for c, k in column_types(frames).items()}
    widened = [f.select(*[F.col(f"`{c}`").cast(target[c]).alias(c) for c in f.columns]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), widened)


def add_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns})
