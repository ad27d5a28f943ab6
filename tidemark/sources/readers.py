"""CSV, JSON and Parquet scans."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.missing import string_columns
from tidemark.operators.unions import diagonal_union

SOURCE_COLUMN = "_source_file"
EMPTY = "\x01"  # stands for a quoted empty cell while reading, as an unquoted one is null
BOM = "﻿"


def as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header. Give a ``schema`` where it is known; ``infer`` costs one more pass."""
    reader = spark.read.option("header", "true").option("inferSchema", str(infer and schema is None).lower())
    return (reader.schema(schema) if schema else reader).csv(as_list(paths))


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first non-blank line of each file, without its byte-order mark."""
    return {path: line for path, (line, _) in file_heads(spark, paths).items()}


def file_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, bool]]:
    """First non-blank line of each file without its byte-order mark, and whether a quoted cell runs over a line
    break (some line holds an odd number of quotes). One scan over all files, one row per file to the driver."""
    def plain(uri: str) -> str:  # local files come with one slash or three
        return re.sub("^file:/+", "/", uri)

    given = {plain(_as_uri(spark, p)): p for p in paths}
    if not given:
        return {}
    lines = spark.read.text(list(given.values())).select(
        F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", BOM, "").alias("line"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    heads = lines.where(F.trim("line") != "").groupBy("path").agg(
        F.min_by("line", "place").alias("line"), F.bool_or(quotes % 2 == 1).alias("open")
    )
    return {given[plain(r["path"])]: (r["line"].strip(), r["open"]) for r in heads.collect()}


def read_csv_text(spark: SparkSession, paths: Sequence[str], lineage: bool = False) -> DataFrame:
    """Every column as text. Files are read together per header line and stacked by column name, because one
    read over different headers would match columns by position. Only files with line breaks inside quotes
    are read whole, one task each; the others stay split."""
    by_header: dict[tuple[str, bool], list[str]] = {}
    for path, head in sorted(file_heads(spark, as_list(paths)).items()):
        by_header.setdefault(head, []).append(path)
    frames = []
    for (_, spread), group in by_header.items():
        frame = spark.read.options(header="true", escape='"', emptyValue=EMPTY, multiLine=str(spread).lower()).csv(group)
        cells = [F.when(F.col(f"`{c}`") != EMPTY, F.col(f"`{c}`")).when(F.col(f"`{c}`") == EMPTY, "").alias(c) for c in frame.columns]
        frames.append((with_source(frame) if lineage else frame).select(*cells, *([SOURCE_COLUMN] if lineage else [])))
    return diagonal_union(frames)


def read_csv_lossy(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None, escape: str = '"',
                   multiline: bool = True) -> DataFrame:
    """Text columns; invalid UTF-8 becomes U+FFFD, surplus fields of a row are cut, quoted newlines are kept.

    Files without a header line need a ``schema``. Quoted newlines keep a file from being split, so turn
    ``multiline`` off for large files without them.
    """
    reader = spark.read.option("multiLine", str(multiline).lower()).option("escape", escape).option("header", str(schema is None).lower())
    return (reader.schema(schema) if schema else reader).csv(as_list(paths))


def read_parquet(spark: SparkSession, paths: str | Sequence[str], merge: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(*as_list(paths))


def read_ndjson(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(as_list(paths))


def json_layouts(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by layout: ``lines`` (one object per line), ``array``, ``object`` (one spread-out object)."""
    paths = as_list(paths)
    lines = first_lines(spark, paths)
    empty = [p for p in paths if p not in lines]
    if empty:
        raise ValueError(f"JSON files without content: {empty}")
    rows = spark.createDataFrame(list(lines.items()), "path string, line string").select(
        "path",
        F.when(F.col("line").startswith("["), "array")
        .when(F.col("line").startswith("{") & F.try_parse_json("line").isNull(), "object")
        .otherwise("lines")
        .alias("layout"),
    )
    found: dict[str, list[str]] = {}
    for row in rows.collect():
        found.setdefault(row["layout"], []).append(row["path"])
    return found


def array_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, object, whole)`` per line of JSON array files; ``whole`` when the line is one object, its
    separators and the array's brackets aside, or has nothing else on it."""
    line = F.trim(F.regexp_replace("value", BOM, ""))
    item = F.regexp_extract(line, r"^\[?\s*(\{.*\})\s*,?\s*\]?$", 1)
    # parsed as a list, so that a second object on the line shows up instead of being ignored
    parsed = F.try_parse_json(F.concat(F.lit("["), item, F.lit("]")))
    single = parsed.isNotNull() & F.try_variant_get(parsed, "$[1]", "variant").isNull()
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        item.alias("object"),
        F.when(item == "", line.rlike(r"^[\[\],\s]*$")).otherwise(single).alias("whole"),
    )


def read_json_arrays(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame:
    """JSON array files. With a ``schema``, files that keep one object per line are read split by line; the
    others, and all files without a schema, take one task per file."""
    paths = as_list(paths)
    frames = []
    if schema:
        lines = array_lines(spark, paths)
        tidy = lines.groupBy("path").agg(F.bool_and("whole").alias("tidy")).where("tidy")
        found = {r["path"] for r in tidy.select("path").collect()}
        split = [p for p in paths if _as_uri(spark, p) in found]
        if split:
            objects = array_lines(spark, split).where(F.col("object") != "")
            frames.append(objects.select(F.from_json("object", schema).alias("o")).select("o.*"))
        paths = [p for p in paths if p not in set(split)]
    if paths:
        reader = spark.read.schema(schema) if schema else spark.read
        frames.append(reader.option("multiLine", "true").json(paths))
    return diagonal_union(frames)


def _as_uri(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` shows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def read_json(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame:
    """JSON files of any layout, stacked by column name. A spread-out object is one task per file."""
    frames = []
    for layout, group in sorted(json_layouts(spark, paths).items()):
        if layout == "array":
            frames.append(read_json_arrays(spark, sorted(group), schema))
            continue
        reader = spark.read.schema(schema) if schema else spark.read
        frames.append(reader.option("multiLine", str(layout == "object").lower()).json(sorted(group)))
    return diagonal_union(frames)


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns as bigint, double, boolean or timestamp where every value fits, else left as text.

    One aggregate decides for all columns, over all rows.
    """
    kinds = ["bigint", "double", "boolean", "timestamp"]
    texts = string_columns(df)
    if not texts:
        return df
    fits = {(c, k): F.count(F.col(f"`{c}`").try_cast(k)) for c in texts for k in kinds}
    present = {c: F.count(F.col(f"`{c}`")) for c in texts}
    row = df.agg(
        *[n.alias(f"n{i}") for i, n in enumerate(present.values())], *[n.alias(f"f{i}") for i, n in enumerate(fits.values())]
    ).first()
    filled = dict(zip(texts, row[: len(texts)]))
    counts = dict(zip(fits, row[len(texts) :]))
    target = {c: next((k for k in kinds if filled[c] and counts[c, k] == filled[c]), "string") for c in texts}
    return df.select(*[F.col(f"`{c}`").cast(target[c]).alias(c) if c in target else F.col(f"`{c}`") for c in df.columns])


def with_source(df: DataFrame, name: str = SOURCE_COLUMN) -> DataFrame:
    """Add the name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def reencode(spark: SparkSession, source: str, target: str, codec: str = "zstd") -> DataFrame:
    spark.read.parquet(source).write.mode("errorifexists").option("compression", codec).parquet(target)
    return spark.read.parquet(target)


def register_views(spark: SparkSession, tables: dict[str, str]) -> list[str]:
    """Temporary views over Parquet folders; names are made safe for SQL."""
    names = []
    for name, path in tables.items():
        safe = re.sub(r"\W+", "_", name)
        spark.read.parquet(path).createOrReplaceTempView(safe)
        names.append(safe)
    return names
