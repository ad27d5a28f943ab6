"""Column expressions: dates in several formats, tolerant casts, fills, maps and text splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.missing import string_columns

DAY_SLASH_FORMAT = "dd/MMM/yyyy"
DAY_PLAIN_FORMAT = "ddMMMyyyy"
C_TIME_FORMAT = "MMM d HH:mm:ss yyyy"  # what %c prints, once the weekday is removed


def parse_timestamp(text: Column, pattern: str, strict: bool = False) -> Column:
    """One format; tolerant parsing gives null where ``strict`` raises."""
    return F.to_timestamp(text, pattern) if strict else F.try_to_timestamp(text, F.lit(pattern))


def parse_c_time(text: Column) -> Column:
    """``Sun Jul  8 00:34:60 2001``: weekday dropped, padding collapsed, second 60 carried over."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3}\s+", ""), r"\s+", " ")
    leap = plain.rlike(r":60 \d{4}$")
    parsed = parse_timestamp(F.regexp_replace(plain, r":60 (\d{4})$", ":59 $1"), C_TIME_FORMAT)
    return F.when(leap, parsed + F.expr("interval 1 second")).otherwise(parsed)


def parse_any(text: Column, patterns: Sequence[str] = (DAY_SLASH_FORMAT, DAY_PLAIN_FORMAT), c_time: bool = True) -> Column:
    """First format that fits."""
    tries = [parse_timestamp(text, p) for p in patterns]
    return F.coalesce(*tries, *([parse_c_time(text)] if c_time else []))


def parse_date_or_null(text: Column, pattern: str | None = None) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern))) if pattern else text.try_cast("date")


def tenure_years(day: Column, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), day) / F.lit(365)


def cast_to(column: Column, dtype: str, strict: bool = True) -> Column:
    """Strict casts raise on bad text; tolerant ones give null."""
    return column.cast(dtype) if strict else column.try_cast(dtype)


def fill_text(df: DataFrame, value: str = "unknown") -> DataFrame:
    """Constant for nulls in the text columns only."""
    return df.na.fill(value, subset=string_columns(df))


def fill_chain(column: Column, *fallbacks: Column) -> Column:
    return F.coalesce(column, *fallbacks)


def unique_filler(column: Column, prefix: str, key: Column) -> Column:
    """Null names become ``<prefix><key>`` so that they stay unique."""
    return F.coalesce(column, F.concat(F.lit(prefix), key.cast("string")))


def map_values(column: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; unknown values give null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), column)


TRUE_FALSE = {"t": True, "f": False}  # fixed values


def explode_json_list(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """One row per list entry; an empty or unreadable list gives one null row."""
    return df.withColumn(name, F.explode_outer(F.from_json(F.col(column), "array<string>")))


def relative_change_percent(before: Column, after: Column) -> Column:
    return F.try_divide(F.abs(after - before), before) * 100


def sanitise_identifier(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}_]+", "_")


def split_lines(df: DataFrame, column: str, name: str = "line", position: str = "line_no") -> DataFrame:
    """One row per line of a text cell, with its 0-based position; a null cell gives one null row."""
    return df.select("*", F.posexplode_outer(F.split(F.col(column), "\n")).alias(position, name))


def part_of(text: Column, index: int, separator: str = "_") -> Column:
    """The ``index``-th part of a split text, empty when there is none."""
    return F.coalesce(F.get(F.split(text, separator), F.lit(index)), F.lit(""))


def labelled(pairs: Sequence[tuple[str, Column]], separator: str = " - ", null_text: str = "nan") -> Column:
    """``name: value`` pairs joined into one label."""
    parts = [
        F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit(null_text))) for name, value in pairs
    ]
    return reduce(lambda a, b: F.concat(a, F.lit(separator), b), parts)
