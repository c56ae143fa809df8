"""Tables clustered across files, with a map of the files that lets a filter choose among them.

Rows are dealt to files by ranges of (year bucket, cluster columns, hash of a key), so a file holds a
short stretch of that order and a filter on the cluster columns concerns few files. The hash cuts a
department or type with a large share of the rows into several ranges. A table is replaced together
with its map:

    data/attempt=.../year_bucket=.../   the rows
    files/attempt=.../                  one row a file: lowest and highest value of every cluster column
    columns/                            the schema, so that an empty table can be read, and the layout

The newest map says which files count. A deletion writes the rows that stay of the files it concerns
into an attempt of its own and then one map file, so readers see the table before it or after it, and
all other files keep their names.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from salesmart.sinks.tables import YEAR_BUCKET, _beside, in_years, replace_folder, year_bucket
from salesmart.sources.contracts import YEAR_RANGE
from salesmart.streaming.manifest import new_batch

CLUSTER = ("department_code", "property_type_code")
ATTEMPT = "attempt"
_COLUMNS = "columns string, key string, cluster array<string>"


def _name() -> Column:
    """The last three steps of the path of a row's file; they stay valid when the folder is renamed."""
    return F.regexp_extract(F.col("_metadata.file_path"), "([^/]+/[^/]+/[^/]+)$", 1)


def _file_map(data: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """One row a file; of the rows only the cluster columns are read."""
    bounds = [f(c).alias(f"{side}_{c}") for c in cluster for side, f in (("low", F.min), ("high", F.max))]
    return (
        data.select(_name().alias("file"), F.col(YEAR_BUCKET).alias("bucket"), *cluster)
        .groupBy("file", "bucket")
        .agg(F.count(F.lit(1)).alias("file_rows"), *bounds)
    )


def write_clustered(
    df: DataFrame,
    path: str,
    key: str = "mutation_id",
    year: str = "transaction_year",
    cluster: Sequence[str] = CLUSTER,
    years: tuple[int, int] = YEAR_RANGE,
) -> int:
    """Replace a table clustered across its files; returns its rows.

    ``key`` is a column with few rows per value; only its hash is used. NULL in the year or a cluster
    column is kept and sorts first. The number of ranges is ``spark.sql.shuffle.partitions``;
    adaptive execution merges small neighbours. Every input row is dealt by its values alone, so a
    task that runs again after a lost executor writes the same rows.
    """
    spark, fresh = df.sparkSession, _beside(df.sparkSession, path)
    placed = df.withColumn(YEAR_BUCKET, year_bucket(F.col(year), years))
    kept = StructType([f for f in placed.schema if f.name != YEAR_BUCKET]).add(YEAR_BUCKET, IntegerType())
    layout = _Layout(kept, key, list(cluster))
    _commit(spark, fresh, new_batch(), placed, layout, None)
    row = (kept.json(), key, list(cluster))
    spark.createDataFrame([row], _COLUMNS).coalesce(1).write.parquet(f"{fresh}/columns")
    replace_folder(spark, fresh, path)
    return _newest_map(spark, path).agg(F.sum("file_rows")).first()[0] or 0


@dataclass(frozen=True)
class _Layout:
    schema: StructType
    key: str
    cluster: list[str]


def _layout(spark: SparkSession, path: str) -> _Layout:
    row = spark.read.schema(_COLUMNS).parquet(f"{path}/columns").first()
    return _Layout(StructType.fromJson(json.loads(row.columns)), row.key, row.cluster)


def _commit(
    spark: SparkSession, path: str, attempt: str, rows: DataFrame, layout: _Layout, others: DataFrame | None
) -> None:
    """Write rows as files of an attempt, then the map that names them beside the files of ``others``."""
    place = f"{path}/data/{ATTEMPT}={attempt}"
    (
        rows.repartitionByRange(YEAR_BUCKET, *layout.cluster, F.xxhash64(layout.key))
        .sortWithinPartitions(YEAR_BUCKET, *layout.cluster)
        .write.partitionBy(YEAR_BUCKET)
        .parquet(place)
    )
    entries = _file_map(spark.read.schema(layout.schema).parquet(place), layout.cluster)
    if others is not None:
        entries = others.unionByName(entries)
    # an entry without a file, so that a map of no files is a map too
    mark = spark.createDataFrame([("",)], "file string")
    entries = entries.unionByName(mark, allowMissingColumns=True)
    # a single file, renamed into place by its writer: the step that makes the attempt count
    entries.coalesce(1).write.parquet(f"{path}/files/{ATTEMPT}={attempt}")


def _newest_map(spark: SparkSession, path: str) -> DataFrame:
    maps = spark.read.parquet(f"{path}/files")
    newest = maps.agg(F.max(ATTEMPT)).first()[0]
    return maps.filter((F.col(ATTEMPT) == newest) & (F.col("file") != "")).drop(ATTEMPT)


def _rows(spark: SparkSession, path: str, files: Sequence[str], schema: StructType) -> DataFrame:
    whole = StructType([*schema.fields]).add(ATTEMPT, "string")
    return spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*files)


def delete_rows(spark: SparkSession, path: str, keep: Column) -> list[str]:
    """Delete the rows for which ``keep`` is not true; returns the names of the files that held any.

    Only these files are read whole and written anew; of the others the columns of the condition are
    read and nothing is written. The files that gave up rows stay on disk, for readers that began
    before, until ``drop_superseded``. One writer at a time.
    """
    layout, files = _layout(spark, path), chosen_files(spark, path)
    if not files:
        return []
    stays = F.coalesce(keep, F.lit(False))
    rows = _rows(spark, path, files, layout.schema)
    # names of files, as in a listing
    touched = sorted(r.file for r in rows.filter(~stays).select(_name().alias("file")).distinct().collect())
    if touched:
        concerned = _rows(spark, path, [f"{path}/data/{f}" for f in touched], layout.schema)
        gone = spark.createDataFrame([(f,) for f in touched], "file string")
        others = _newest_map(spark, path).join(gone, "file", "left_anti")
        _commit(spark, path, new_batch(), concerned.filter(stays).drop(ATTEMPT), layout, others)
    return touched


def drop_superseded(spark: SparkSession, path: str) -> list[str]:
    """Remove the files that the newest map does not name, those of dead attempts included; returns
    their names. For times when nobody reads an older state or writes a new one."""
    named = set(chosen_files(spark, path))
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, gone = system.listFiles(place, True), []
    while listed.hasNext():
        file = listed.next().getPath()
        steps = str(file.toString()).split("/")[-3:]
        if file.getName().endswith(".parquet") and f"{path}/data/{'/'.join(steps)}" not in named:
            gone.append("/".join(steps))
            system.delete(file, False)
    return sorted(gone)


def _may_hold(column: str, values: Sequence) -> Column:
    """Whether the bounds of a file leave room for one of the values; a file of NULLs has none."""
    low, high = F.col(f"low_{column}"), F.col(f"high_{column}")
    hits = [F.lit(v).between(low, high) for v in values if v is not None]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def chosen_files(
    spark: SparkSession,
    path: str,
    years: tuple[int, int] | None = None,
    values: Mapping[str, Sequence] | None = None,
) -> list[str]:
    """Files that can hold rows of the filter; their names alone reach the driver, as in any file listing."""
    files = _newest_map(spark, path)
    if years:
        bucket = F.col("bucket")
        files = files.filter(bucket.between(*years) | bucket.isNull())
    for column, wanted in (values or {}).items():
        if f"low_{column}" in files.columns:
            files = files.filter(_may_hold(column, wanted))
    return sorted(f"{path}/data/{r.file}" for r in files.select("file").collect())


def read_clustered(
    spark: SparkSession,
    path: str,
    years: tuple[int, int] | None = None,
    values: Mapping[str, Sequence] | None = None,
    year: str = "transaction_year",
) -> DataFrame:
    """Rows of ``years`` whose columns are among ``values``, read from the files that can hold them.

    ``values`` maps any column to the values wanted; a column that is no cluster column filters rows
    only. As in SQL, NULL is never among the values and an empty list leaves no row. The rows are
    filtered as well, so bounds that are wide cost time and never change the result.
    """
    schema = _layout(spark, path).schema
    files = chosen_files(spark, path, years, values)
    if not files:
        return spark.createDataFrame([], schema)
    rows = _rows(spark, path, files, schema).drop(ATTEMPT)
    if years:
        rows = in_years(rows, *years, year)
    for column, wanted in (values or {}).items():
        rows = rows.filter(F.col(column).isin(*[v for v in wanted if v is not None]))
    return rows
