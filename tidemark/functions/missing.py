"""Null conventions: a float NaN counts as missing everywhere, and results hold nulls only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

FRACTIONAL = (T.DoubleType, T.FloatType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_missing(df: DataFrame, name: str) -> Column:
    """True where the column holds null, or NaN for float columns."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_if_nan(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return F.when(~F.isnan(column), column)
    return column


def nan_to_null(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with NaN turned into null in the named float columns; other columns are left alone."""
    floats = [n for n in dict.fromkeys(names) if isinstance(df.schema[n].dataType, FRACTIONAL)]
    return df.withColumns({n: null_if_nan(df, n) for n in floats}) if floats else df


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    """Names of the columns whose type is one of ``kinds``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, *NUMERIC)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)
