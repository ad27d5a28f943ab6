"""Run manifest: what was converted, what can be skipped, and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.writers import exists

MANIFEST_SCHEMA = (
    "run_id string, task_id string, status string, started_at timestamp, finished_at timestamp, duration double, "
    "error string, files_read long, files_written long, retries long, "
    "transfer_result array<struct<input_file:string,output_file:string,sheet_name:string,"
    "schema:array<struct<column:string,dtype:string>>,rows:long,columns:int,size_mb:double>>"
)
SUCCESS, FAILED, READY = "success", "failed", "ready"


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest table; empty when there is none yet."""
    if exists(spark, path):
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def append_manifest(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Appended after each task, so an interrupted run keeps what it finished."""
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def last_status(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("task_id").agg(F.max_by("status", "finished_at").alias("status"))


def unfinished(tasks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Tasks whose last recorded run did not succeed."""
    done = last_status(manifest).where(F.col("status") == SUCCESS)
    return tasks.join(done.select("task_id"), "task_id", "left_anti")


def totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("run_id").agg(
        F.sum("files_read").alias("files_read"),
        F.sum("files_written").alias("files_written"),
        F.count_if(F.col("status") == SUCCESS).alias("success"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.sum("retries").alias("retries"),
        F.sum("duration").alias("duration"),
    )


def ready_jobs(registry: DataFrame, status: DataFrame, destination: str) -> DataFrame:
    """Registered sources that were reachable, as jobs ready to run."""
    return (
        registry.join(status, "name", "inner")
        .where("reachable")
        .select("name", "path", F.lit(destination).alias("destination"), F.lit(READY).alias("status"))
    )
