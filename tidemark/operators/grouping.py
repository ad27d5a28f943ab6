"""Which files belong together, and which sheets they share. Everything stays in rows ``(group, path, …)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.ordering import row_position
from tidemark.sources.listing import file_stem

# Endings that number or copy a file, removed in this order, any case.
COPY_ENDINGS = [
    r"[_\s]+v?\d+[\s_]*$",
    r"[\s_]*\(\d+\)[\s_]*$",
    r"[_\s]+\d+of\d+[\s_]*$",
    r"[_\s]+part\d+[\s_]*$",
    r"[_\s]+copy[\s_]*$",
    r"[_\s]+backup[\s_]*$",
]

# Shape of template file names.
TEMPLATE_COPY = r"\s*\(\d+\)\s*$"
TEMPLATE_ENDING = r"(?i)\s+(new|copy|v\d+|final|revised|updated|\d+)$"
TEMPLATE_PREFIX = r"(?i)^Data Template\s+"
TEMPLATE_NAME = r"(?i)Data Template\s+[^_]+_(.+?)_C\d+R\d+_"

TASK_ROWS = 500_000


@dataclass(frozen=True)
class GroupConfig:
    """A named group: files whose stem matches ``pattern`` from its start, or contains the name."""

    name: str
    pattern: str = ""
    ignore_sheets: tuple[str, ...] = field(default_factory=tuple)


def base_name(stem: Column) -> Column:
    stripped = reduce(lambda s, p: F.regexp_replace(s, f"(?i){p}", ""), COPY_ENDINGS, stem)
    return F.trim(F.regexp_replace(stripped, r"^_+|_+$", ""))


def template_name(stem: Column) -> Column:
    """Business name inside a template file name; else the part after the first underscore; else the stem."""
    plain = F.trim(F.regexp_replace(F.trim(F.regexp_replace(stem, TEMPLATE_COPY, "")), TEMPLATE_ENDING, ""))
    inside = F.trim(F.regexp_extract(plain, TEMPLATE_NAME, 1))
    parts = F.split(F.regexp_replace(plain, TEMPLATE_PREFIX, ""), "_")
    second = F.when(F.size(parts) >= 2, F.trim(F.get(parts, F.lit(1))))
    return F.coalesce(F.nullif(inside, F.lit("")), second, plain)


def group_by_base_name(files: DataFrame) -> DataFrame:
    return files.withColumn("group", base_name(file_stem(F.col("path"))))


def group_by_template(files: DataFrame) -> DataFrame:
    return files.withColumn("group", template_name(file_stem(F.col("path"))))


def group_by_config(files: DataFrame, configs: Sequence[GroupConfig]) -> DataFrame:
    """One row per file and matching group; a file may join several groups, others drop out.

    The configurations are parameters, so each file tests them in place: no join is needed.
    """
    stem = file_stem(F.col("path"))
    hits = [
        F.when(stem.rlike(f"^(?:{c.pattern})") if c.pattern else stem.contains(c.name), F.lit(c.name)) for c in configs
    ]
    return files.withColumn("group", F.explode(F.array_compact(F.array(*hits))))


def group_sizes(grouped: DataFrame) -> DataFrame:
    """Files per group, the first path and whether all files have one type."""
    return grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("first_path"), F.count_distinct("file_type").alias("types")
    )


def number_key(digits: Column) -> Column:
    """Digits of any length so that they sort by value: their number without leading zeros, then themselves."""
    bare = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)


def natural_key(name: Column) -> Column:
    """Sort key under which ``Sheet2`` comes before ``Sheet10``."""
    pieces = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    padded = F.transform(pieces, lambda p: F.when(p.rlike(r"^\d+$"), number_key(p)).otherwise(p))
    return F.array_join(padded, "")


def dealt(sheets: DataFrame) -> DataFrame:
    """The rows dealt out by workbook over so many partitions that each holds about ``TASK_ROWS``, however few tasks read them."""
    return sheets.repartition(max(1, -(-sheets.count() // TASK_ROWS)), "group", "path")


def common_sheets(sheets: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """Sheets that all workbooks of a group have, without the ignored ones, in natural order.

    ``sheets`` has (group, path, sheet); ``ignored`` has (group, sheet).
    """
    sheets = dealt(sheets)
    workbooks = sheets.groupBy("group").agg(F.count_distinct("path").alias("workbooks"))
    shared = (
        sheets.groupBy("group", "sheet")
        .agg(F.count_distinct("path").alias("found"))
        .join(workbooks, "group")
        .where(F.col("found") == F.col("workbooks"))
    )
    if ignored is not None:
        shared = shared.join(ignored, ["group", "sheet"], "left_anti")
    keyed = shared.select("group", "sheet", natural_key(F.col("sheet")).alias("natural"))
    return row_position(keyed, ["natural", "sheet"], "ord", ["group"]).select("group", "ord", "sheet")


def first_file_sheets(sheets: DataFrame) -> DataFrame:
    """Sheets of the first workbook (by path) of each group."""
    sheets = dealt(sheets)  # the smallest text is found by sorting, so a task should hold a bounded number of rows
    first = sheets.groupBy("group").agg(F.min("path").alias("path"))
    return sheets.join(first, ["group", "path"], "left_semi").select("group", "sheet_no", "sheet")
