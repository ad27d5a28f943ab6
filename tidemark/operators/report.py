"""Summaries of validation reports: exploded comments, counts and the first samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.ordering import row_position
from tidemark.functions.scalars import labelled, part_of, split_lines

SAMPLES = 5


def sample_labels(df: DataFrame, id_columns: Sequence[str], sheet: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """Add ``report_index`` (sorted position + 2, counted from 0 per sheet) and the ``sample`` label built from it."""
    ordered = row_position(df, [*id_columns, *tie], "report_index", sheet, start=2)
    label = F.concat(
        labelled([(c, F.col(f"`{c}`")) for c in id_columns]),
        F.lit("(Report index: "),
        F.col("report_index").cast("string"),
        F.lit(")"),
    )
    return ordered.withColumn("sample", label)


def split_messages(df: DataFrame, comment: str, mode: str = "Pre") -> DataFrame:
    """One row per comment line. In ``Pre`` mode a line ``code_type_message`` gives type and message;
    otherwise the whole line is the message."""
    lines = split_lines(df, comment, "line", "line_no")
    text = F.coalesce(F.col("line"), F.lit("nan"))
    if mode == "Pre":
        return lines.withColumns({"error_type": part_of(text, 1), "message": part_of(text, 2)})
    return lines.withColumns({"error_type": F.lit(""), "message": text})


def first_samples(lines: DataFrame, keys: Sequence[str], samples: int = SAMPLES) -> DataFrame:
    """The first samples of each group, one per line of text.

    Spark cuts the ranked window to ``samples`` rows per group before the shuffle, so the full list of a
    frequent message is never gathered.
    """
    first = Window.partitionBy(*keys).orderBy("report_index", "line_no")
    return (
        lines.select(*keys, "report_index", "line_no", "sample")
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= samples)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("__rank", "sample"))).alias("__s"))
        .select(*keys, F.array_join(F.transform("__s", lambda x: x["sample"]), "\n").alias("samples"))
    )


def summarise(df: DataFrame, status: str, sheet: Sequence[str] = (), mode: str = "Pre", samples: int = SAMPLES) -> DataFrame:
    """Amount and first samples per message, status and type; rows without message or status are left out."""
    keys = [*sheet, "message", status, "error_type"]
    lines = df.na.drop(subset=keys)
    amounts = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("amount"))
    out = null_safe_join(amounts, first_samples(lines, keys, samples), keys)
    shown = "error_type" if mode == "Pre" else status
    return out.select(*sheet, shown, "message", "amount", "samples")


def occurrences(df: DataFrame, id_column: str, comment: str) -> DataFrame:
    """Older report form: every ``id - row`` per trimmed comment line, with the line's number of occurrences.

    Kept one row per occurrence, since a frequent comment would not fit one cell.
    """
    lines = split_lines(df.withColumn(comment, F.trim(comment)), comment, "line", "line_no").withColumn("line", F.trim("line"))
    amounts = lines.groupBy("line").agg(F.count(F.lit(1)).alias("amount"))
    final_id = F.concat(F.col(id_column).cast("string"), F.lit(" - "), F.col("report_index").cast("string"))
    return null_safe_join(lines.withColumn("final_id", final_id), amounts, ["line"]).select("line", "final_id", "amount")
