"""Resumable ingest of a growing folder: each file is taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def ingest_new_files(spark: SparkSession, folder: str, schema: str, target: str, progress: str, fmt: str = "csv") -> DataFrame:
    """Append the files that arrived since the last call and return the whole target.

    The file source keeps its own log of finished files in ``progress`` (a shared folder), so a stopped or
    failed run resumes where it was; ``availableNow`` ends the query once nothing is left.
    """
    stream = (
        spark.readStream.format(fmt).schema(schema).option("header", "true").option("escape", '"').option("recursiveFileLookup", "true").load(folder)
        .withColumn("_source_file", F.col("_metadata.file_name"))
    )
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)
