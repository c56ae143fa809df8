"""Manifest of ingested files: the truth about which rows of which batch count."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import path_exists

SCHEMA = (
    "source_file string, batch_id string, table_name string, row_count long, "
    "committed_at timestamp"
)


def new_batch() -> str:
    """Name of one attempt; later ones sort behind earlier ones."""
    return f"b{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed entries. Only a missing folder is a fresh start; a damaged part, missing rights
    or another schema are errors that name the file, never a shorter manifest."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def append_manifest(counts: DataFrame, batch: str, path: str) -> None:
    """Record a batch after its data is committed."""
    counts.select(
        "source_file",
        "table_name",
        "row_count",
        F.current_timestamp().alias("committed_at"),
    ).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def current_entries(manifest: DataFrame) -> DataFrame:
    """Entries of the newest batch of each file. Older batches of a file count no more, also for
    tables that the newest one does not hold."""
    newest = manifest.groupBy("source_file").agg(F.max("batch_id").alias("batch_id"))
    return manifest.join(newest, ["source_file", "batch_id"], "left_semi")


def resume_anti_join(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that no batch has committed yet."""
    done = manifest.select("source_file").distinct()
    return files.join(done, "source_file", "left_anti")


def accumulate_row_counts(manifest: DataFrame) -> DataFrame:
    """Rows per table over the newest entry of each file, and the number of files with the table."""
    return (
        current_entries(manifest)
        .filter("table_name <> ''")
        .groupBy("table_name")
        .agg(F.sum("row_count").alias("row_count"), F.count_distinct("source_file").alias("files"))
    )
