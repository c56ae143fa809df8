"""Writers and the counts that confirm them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from salesmart.sources.contracts import YEAR_RANGE

YEAR_BUCKET = "year_bucket"
BATCH = "batch_id"
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows seen by the write itself. The writing stage counts each partition once, also when a
    lost executor makes it run again; a stage ahead of a shuffle would not."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a finished folder in the place of another by renaming, the old one last to go.

    Readers see the old or the new table; only between two renames there is none. A failed write
    never gets this far, so it leaves the old table as it was.
    """
    new, place = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path))
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh}-old")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"could not move {path} away")
    if not had:
        files.mkdirs(place.getParent())
    if not files.rename(new, place):
        raise OSError(f"could not move {fresh} to {path}")
    if had:
        files.delete(old, True)


def _beside(spark: SparkSession, path: str) -> str:
    """Fresh folder in the same place, hidden from readers of the parent."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    return f"{whole.getParent()}/_{whole.getName()}-{uuid.uuid4().hex[:8]}"


def write_csv_export(df: DataFrame, path: str) -> int:
    """CSV with header; NULL is an empty field, an empty text is quoted, blanks stay. Replaces an
    earlier export once it is whole. Returns the row count."""
    counted, seen = _counted(df)
    fresh = _beside(df.sparkSession, path)
    counted.write.options(**CSV_WRITE_OPTIONS).csv(fresh)
    replace_folder(df.sparkSession, fresh, path)
    return seen.get["rows"]


def write_truncate(df: DataFrame, path: str) -> int:
    """Full replacement of a table; running it again leaves the same rows."""
    counted, seen = _counted(df)
    fresh = _beside(df.sparkSession, path)
    counted.write.parquet(fresh)
    replace_folder(df.sparkSession, fresh, path)
    return seen.get["rows"]


def year_bucket(year: Column, years: tuple[int, int] = YEAR_RANGE) -> Column:
    """Partition of a row: its year inside ``[start, end)``, else the NULL partition."""
    value = year.cast("int")
    return F.when((value >= years[0]) & (value < years[1]), value)


def write_partitioned_clustered(
    df: DataFrame,
    path: str,
    year: str = "transaction_year",
    cluster: tuple[str, ...] = ("department_code", "property_type_code"),
    years: tuple[int, int] = YEAR_RANGE,
) -> int:
    """Replace a table partitioned by year and sorted inside its files by the cluster columns.

    REBALANCE hashes on year and first cluster column and lets adaptive execution cut oversized
    and merge undersized tasks, so a year or department that holds a third of the rows is written
    by many tasks while small ones do not scatter into tiny files.
    """
    fresh = _beside(df.sparkSession, path)
    (
        df.withColumn(YEAR_BUCKET, year_bucket(F.col(year), years))
        .hint("rebalance", YEAR_BUCKET, cluster[0])
        .sortWithinPartitions(YEAR_BUCKET, *cluster)
        .write.partitionBy(YEAR_BUCKET)
        .parquet(fresh)
    )
    replace_folder(df.sparkSession, fresh, path)
    # counted from the footers of the files just written
    return df.sparkSession.read.parquet(path).count()


def in_years(df: DataFrame, first: int, last: int, year: str = "transaction_year") -> DataFrame:
    """Rows of ``first..last``; on a table by year buckets other partitions are not listed or read.

    Years outside the bounds the table was written with are in its NULL partition, so that one is
    read as well, and the result is right for any bounds.
    """
    rows = F.col(year).between(first, last)
    if YEAR_BUCKET in df.columns:
        bucket = F.col(YEAR_BUCKET)
        rows = rows & (bucket.between(first, last) | bucket.isNull())
    return df.filter(rows)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Table hashed and sorted by ``key``: joins and groupings on the key need no shuffle.

    One task writes and later reads a bucket, so this is for tables with few rows per key, such as
    sales and aggregated children; a key with a large share of all rows would make one big bucket.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .format("parquet")
        .saveAsTable(table)
    )


def write_chunk(df: DataFrame, path: str, batch: str) -> int:
    """Rows of one batch as their own folder: a repeat replaces it, also by nothing, and other
    batches stay. Only the batch's folder is touched, once its rows are whole."""
    counted, seen = _counted(df)
    place = f"{path}/{BATCH}={quote(batch, safe='')}"
    fresh = _beside(df.sparkSession, place)
    counted.write.parquet(fresh)
    replace_folder(df.sparkSession, fresh, place)
    return seen.get["rows"]


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All batches, each under the very name it was written with (``001`` is not ``1``)."""
    found = spark.read.parquet(path).schema
    schema = StructType([f for f in found if f.name != BATCH]).add(BATCH, StringType())
    return spark.read.schema(schema).parquet(path)


def materialize_layer(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    database: str | None = None,
    location: str | None = None,
    view: bool = False,
) -> str:
    """Publish a model as a view or as a table of ``database``; returns the name to query.

    A database that does not exist yet is created, below ``location`` if that is given.
    """
    if view:
        df.createOrReplaceTempView(name)
        return name
    target = f"{database}.{name}" if database else name
    if database:
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    df.write.mode("overwrite").saveAsTable(target)
    return target


def load_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and their total, also for empty tables."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("(total)")).alias("table_name"), "row_count"
    )


def list_partitions(df: DataFrame, column: str = YEAR_BUCKET) -> DataFrame:
    """Rows per partition; only the partition values and row counts are read."""
    return df.groupBy(F.col(column).alias("partition_id")).agg(
        F.count(F.lit(1)).alias("total_rows")
    )
