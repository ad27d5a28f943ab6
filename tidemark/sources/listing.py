"""Folders as tables: one row per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Extensions with a reader.
FILE_TYPES = {
    ".csv": "csv",
    ".json": "json",
    ".jsonl": "json",
    ".parquet": "parquet",
    ".pq": "parquet",
    ".xlsx": "excel",
    ".xls": "excel",
}


def file_type(path: Column) -> Column:
    """Type from the extension, any case; null when there is no reader."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    pairs = [F.lit(x) for item in FILE_TYPES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), extension)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def require_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        raise FileNotFoundError(f"{folder} does not exist")
    if not files.getFileStatus(path).isDirectory():
        raise NotADirectoryError(f"{folder} is not a folder")


def list_files(spark: SparkSession, folder: str, recursive: bool = False, supported_only: bool = True) -> DataFrame:
    """``(path, length, modified, file_type)``; file contents are not read.

    Files of length zero hold no rows; Spark's file scan leaves them out.
    """
    require_folder(spark, folder)
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    listed = reader.load(folder).select(
        "path", "length", F.col("modificationTime").alias("modified"), file_type(F.col("path")).alias("file_type")
    )
    return listed.where(F.col("file_type").isNotNull()) if supported_only else listed


def paths_of(files: DataFrame, *types: str) -> list[str]:
    """File paths for a reader, sorted: names only, never contents."""
    kept = files.where(F.col("file_type").isin(*types)) if types else files
    return sorted(r["path"] for r in kept.select("path").collect())


def chunks(items: Sequence[str], size: int = 100) -> list[list[str]]:
    return [list(items[i : i + size]) for i in range(0, len(items), size)]
