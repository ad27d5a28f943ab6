"""Parquet, CSV, JSON and table sinks, and the facts about what was written."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import pin

# Quotes are doubled and blanks at the ends of a cell kept, so that every text survives
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
SUFFIX = {"parquet": "parquet", "csv": "csv", "json": "json"}


@dataclass(frozen=True)
class WriteOptions:
    compression: str | None = "zstd"
    rows_per_file: int | None = None
    deduplicate: bool = False
    header: bool = True
    partition_by: tuple[str, ...] = ()


@dataclass
class OutputFacts:
    output: str
    rows: int = 0
    columns: int = 0
    size_mb: float = 0.0
    schema: list[tuple[str, str]] = field(default_factory=list)
    written: bool = False


def safe_name(name: str) -> str:
    """Slashes would open a subfolder."""
    return re.sub(r"[/\\]", "_", name).strip()


def output_name(group: Column, sheet: Column, suffix: str) -> Column:
    """``group.ext`` or ``group.sheet.ext``."""
    return F.regexp_replace(F.concat_ws(".", group, sheet, F.lit(suffix)), r"[/\\]", "_")


def table_name(name: str | None) -> str:
    """A legal table name; ``data`` when nothing else is known."""
    return re.sub(r"\W+", "_", name or "data").strip("_") or "data"


def folder_size(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished output, so that it is not written again. A folder is finished once its
    writer has left the success marker; what an aborted write left behind does not count."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target) or files.getContentSummary(target).getLength() == 0:
        return False
    return not files.getFileStatus(target).isDirectory() or files.exists(hadoop.Path(target, "_SUCCESS"))


def written_rows(out: DataFrame, path: str, fmt: str) -> int:
    """Rows of a finished output: from Parquet footers, or lines of JSON. A CSV reader drops blank lines, so
    there the table itself is counted, which ``write`` has pinned.

    An ``Observation`` would count while writing, but a Spark 4.1 session that has used one cannot run a
    freshly fitted logistic model any more.
    """
    if fmt == "parquet":
        return out.sparkSession.read.parquet(path).count()
    if fmt == "json":
        return out.sparkSession.read.text(path).count()
    return out.count()


def write(
    df: DataFrame, path: str, fmt: str = "parquet", options: WriteOptions = WriteOptions(), skip_existing: bool = False
) -> OutputFacts:
    """Write a table and report rows, columns, schema and size.

    Empty tables are not written.
    """
    spark = df.sparkSession
    facts = OutputFacts(path)
    if skip_existing and exists(spark, path):
        return facts
    out = df.dropDuplicates() if options.deduplicate else df
    if fmt == "csv":
        out = df = pin(out)  # computed once for the check, the file and the count
    if df.isEmpty():
        return facts
    writer = out.write.mode("overwrite")
    if options.rows_per_file:
        writer = writer.option("maxRecordsPerFile", options.rows_per_file)
    if options.partition_by:
        writer = writer.partitionBy(*options.partition_by)
    if fmt == "parquet":
        writer.option("compression", options.compression or "snappy").parquet(path)
    elif fmt == "csv":
        writer.options(**CSV_TEXT, header=str(options.header).lower()).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"no writer for {fmt}")
    facts.rows, facts.columns, facts.written = written_rows(out, path, fmt), len(out.columns), True
    facts.schema = [(f.name, f.dataType.simpleString()) for f in out.schema.fields]
    facts.size_mb = round(folder_size(spark, path) / 1024**2, 4)
    return facts


def save_table(df: DataFrame, name: str | None, path: str | None = None) -> str:
    """Create or replace a named table; the name is made legal first and returned."""
    table = table_name(name)
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def facts_table(spark: SparkSession, facts: list[OutputFacts]) -> DataFrame:
    rows = [(f.output, f.rows, f.columns, f.size_mb, f.written, f.schema) for f in facts]
    return spark.createDataFrame(
        rows,
        "output string, rows long, columns int, size_mb double, written boolean, "
        "schema array<struct<column:string,dtype:string>>",
    )
