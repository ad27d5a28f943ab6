"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    A cluster keeps its own master, memory and shuffle settings; only semantics (ANSI, UTC), adaptive
    execution and the handling of checkpoint files (compressed, removed once unused) are set here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.checkpoint.compress", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    Unlike a cached frame the result survives lost executors, and its rows and partitions stay as written.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def pin_for_reuse(df: DataFrame) -> DataFrame:
    """``pin`` for frames that are read many times: one left in fewer partitions than there are cores (so a
    small one) is dealt out over all of them."""
    pinned = pin(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return pin(pinned.repartition(cores)) if pinned.rdd.getNumPartitions() < cores else pinned


def pin_columns(df: DataFrame) -> DataFrame:
    """``pin`` for large tables that are scanned many times: written as Parquet, so that a scan reads the columns it needs, by batches."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``pin`` that also returns the row count and the size in bytes, measured on what was written."""
    pinned = pin(df)
    fixed, seen = 8, [F.count(F.lit(1)).alias("rows")]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        if isinstance(field.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            seen.append(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias(f"b{len(seen)}"))
            fixed += 8
        else:
            fixed += 16
    counts = pinned.agg(*seen).first()
    return pinned, counts[0], counts[0] * fixed + sum(counts[1:])
