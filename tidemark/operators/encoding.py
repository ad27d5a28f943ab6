"""Finding and repairing text that is not valid UTF-8. Lines are raw bytes in a text column: the text
source keeps bytes as they are."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from tidemark.functions.joins import null_safe_join
from tidemark.operators.aggregates import unique_flagged_values

LATIN_1, UTF_8 = "ISO-8859-1", "UTF-8"
BUILT_IN = {"iso-8859-1": LATIN_1, "latin-1": LATIN_1, "latin1": LATIN_1, "utf-8": UTF_8, "utf8": UTF_8, "us-ascii": "US-ASCII", "ascii": "US-ASCII"}
ISSUE = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("bad_bytes", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, value)``, one row per line with its bytes untouched."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, line, value)`` with 1-based line numbers per file.

    Rows of a text split carry their split's offset; lines are counted per split and shifted by the
    lines of the earlier splits of the same file, so that large files stay split.
    """
    tagged = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    per_block = tagged.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_block.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    # rows of one split are consecutive within their task, so the sequence number gives the place in it
    return null_safe_join(tagged, shifts, ["path", "block"], "inner").select(
        "path", (F.col("before") + F.col("seq") - F.col("first") + 1).alias("line"), "value"
    )


@pandas_udf(ISSUE)
def first_issue(lines: pd.Series) -> pd.DataFrame:
    found = []
    for raw in lines:
        try:
            bytes(raw).decode("utf-8")
            found.append((None, None, None, None))
        except UnicodeDecodeError as e:
            found.append((e.start, e.end, bytes(raw)[e.start : e.end].hex(), e.reason))
    return pd.DataFrame(found, columns=["start", "end", "bad_bytes", "reason"]).astype({"start": "Int32", "end": "Int32"})


def non_utf8_lines(lines: DataFrame, keep: Sequence[str] = ("path", "line")) -> DataFrame:
    """First invalid byte sequence of every invalid line, next to the ``keep`` columns. Valid lines are
    dropped in the JVM; only the rest reaches Python."""
    bad = lines.where(~F.is_valid_utf8("value"))
    return bad.withColumn("issue", first_issue(F.col("value").cast("binary"))).select(*keep, "issue.*")


def decode_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """For columns read as ISO-8859-1: the text decoded as UTF-8 with replacement, a flag per column and one per row."""
    columns = list(columns or df.columns)
    raw = {c: F.encode(F.col(f"`{c}`"), LATIN_1).cast("string") for c in columns}
    bad = {c: F.coalesce(~F.is_valid_utf8(raw[c]), F.lit(False)) for c in columns}
    return df.select(
        *[F.make_valid_utf8(raw[c]).alias(c) if c in raw else F.col(f"`{c}`") for c in df.columns],
        *[bad[c].alias(f"{c}_non_utf8") for c in columns],
        reduce(or_, bad.values()).alias("non_utf8"),
    )


def bad_values(decoded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct damaged values per column."""
    return unique_flagged_values(decoded, {c: F.col(f"{c}_non_utf8") for c in columns})


def decode_from(value: Column, encoding: str) -> Column:
    """Text of raw bytes in ``encoding``; encodings the JVM side does not offer go through Arrow."""
    built_in = BUILT_IN.get(encoding.lower())
    if built_in == UTF_8:
        return F.make_valid_utf8(value)
    if built_in:
        return F.decode(value.cast("binary"), built_in)

    @pandas_udf(T.StringType())
    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else bytes(b).decode(encoding, errors="replace"))

    return decode(value.cast("binary"))


@pandas_udf(T.StringType())
def drop_invalid(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else bytes(b).decode("utf-8", errors="ignore"))


def repair(value: Column, policy: str = "replace") -> Column:
    """``replace`` puts U+FFFD for invalid bytes, ``ignore`` drops them; valid text never reaches Python."""
    if policy == "replace":
        return F.make_valid_utf8(value)
    if policy == "ignore":
        return F.when(F.is_valid_utf8(value), value).otherwise(drop_invalid(value.cast("binary")))
    raise ValueError(f"unknown policy: {policy}")


def detect_encoding(lines: DataFrame) -> DataFrame:
    """Per file: ascii, utf-8 or iso-8859-1, with the share of invalid lines.

    A byte-order mark needs no case of its own: the text source drops it while reading.
    """
    value = F.col("value")
    ascii_only = F.octet_length(value) == F.char_length(F.make_valid_utf8(value))
    return (
        lines.groupBy("path")
        .agg(
            F.bool_and(ascii_only & F.is_valid_utf8(value)).alias("ascii"),
            F.bool_and(F.is_valid_utf8(value)).alias("utf8"),
            F.avg((~F.is_valid_utf8(value)).cast("int")).alias("invalid_share"),
        )
        .select(
            "path",
            F.when(F.col("ascii"), "ascii")
            .when(F.col("utf8"), "utf-8")
            .otherwise("iso-8859-1")
            .alias("encoding"),
            "invalid_share",
        )
    )


def output_name(path: Column, source: str) -> Column:
    """Name of a file's output: its path below ``source`` without ending, so that equal names in different folders stay apart."""
    inside = F.substring_index(path, source.rstrip("/").split(":", 1)[-1].rstrip("/") + "/", -1)
    plain = F.regexp_replace(F.regexp_replace(inside, r"^[a-z]+:/+", ""), r"\.[^./]*$", "")
    return F.concat(F.regexp_replace(plain, "/", "__"), F.lit("_utf8"))


def fix_encoding(spark: SparkSession, source: str, target: str, strategy: str = "replace") -> DataFrame:
    """Convert all files below ``source`` to UTF-8 and return the detected encodings.

    ``reencode`` decodes each file from what was detected; ``replace`` and ``ignore`` repair it as UTF-8.
    Lines keep their file, one output folder per input file.
    """
    lines = raw_lines(spark, source)
    detected = detect_encoding(lines)
    if strategy == "reencode":
        value = F.when(F.col("encoding") == "iso-8859-1", decode_from(F.col("value"), LATIN_1)).otherwise(
            F.make_valid_utf8(F.col("value"))
        )
        known = null_safe_join(lines, detected.select("path", "encoding"), ["path"], "inner")
        lines = known.select("path", value.alias("value"))
    else:
        lines = lines.select("path", repair(F.col("value"), strategy).alias("value"))
    lines.select("value", output_name(F.col("path"), source).alias("file")).write.mode("overwrite").partitionBy("file").text(target)
    return detected


def read_or_repair(spark: SparkSession, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Read text; repair it when it is not UTF-8; report what is still invalid with line and position."""
    fix_encoding(spark, source, target, "reencode")
    fixed = spark.read.text(target).select("file", "value")
    left = non_utf8_lines(numbered_lines(spark, target))
    return fixed, left


def fix_mojibake(text: Column) -> Column:
    """UTF-8 that was decoded as ISO-8859-1 once: ``cafÃ©`` becomes ``café``; other text stays."""
    single = text.rlike(r"^[\x00-\xFF]*$") & text.rlike(r"[\x80-\xFF]")
    # ``encode`` raises on characters above U+00FF, so it only sees text without them
    raw = F.encode(F.when(single, text), LATIN_1)
    return F.when(single & F.is_valid_utf8(raw.cast("string")), F.decode(raw, UTF_8)).otherwise(text)
