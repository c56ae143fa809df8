"""Partitioned tables that change by whole commits.

Every attempt writes the partitions it changes into a folder of its own, ``data/attempt=...``, and
then one manifest file that names, for every partition of the table, the attempt that holds it.
Readers follow the newest manifest, so they see the table before a commit or after it, whatever an
attempt that died has left behind; partitions that a commit does not touch keep their files. One
writer at a time; the partition column holds whole numbers or NULL.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.session import path_exists, remove_folder
from salesmart.streaming.manifest import new_batch

_MANIFEST = "partition string, holder string, columns string"
_NULL = "__HIVE_DEFAULT_PARTITION__"

Entries = dict[str, str]


def _folder(value: int | None) -> str:
    return _NULL if value is None else str(value)


def _newest(spark: SparkSession, path: str) -> tuple[Entries, StructType] | None:
    """Partition -> attempt of the newest commit, and the columns; one row a partition reaches the driver."""
    if not path_exists(spark, f"{path}/manifest"):
        return None
    rows = spark.read.schema(f"{_MANIFEST}, attempt string").parquet(f"{path}/manifest")
    last = rows.agg(F.max("attempt")).first()[0]
    if last is None:
        return None
    found = rows.where(F.col("attempt") == last).collect()
    return {r.partition: r.holder for r in found if r.holder}, StructType.fromJson(json.loads(found[0].columns))


def read_release(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """The table as of its newest commit; filters on ``partition`` still choose folders."""
    newest = _newest(spark, path)
    if newest is None:
        raise FileNotFoundError(f"no release in {path}")
    entries, columns = newest
    if not entries:
        return spark.createDataFrame([], columns)
    folders = [f"{path}/data/attempt={holder}/{partition}={name}" for name, holder in sorted(entries.items())]
    whole = StructType([*columns.fields]).add("attempt", "string")
    rows = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*columns.names)


def has_release(spark: SparkSession, path: str) -> bool:
    return _newest(spark, path) is not None


def _commit(spark: SparkSession, path: str, attempt: str, entries: Entries, columns: StructType) -> None:
    """The one step that makes an attempt count: a single file, renamed into place by its writer."""
    rows = [(name, holder, columns.json()) for name, holder in entries.items()] or [("", "", columns.json())]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/attempt={attempt}")


def commit_partitions(df: DataFrame, path: str, partition: str, replaced: list[int | None]) -> None:
    """Put the rows of ``df`` in the place of the partitions in ``replaced``; the others stay as they are."""
    spark, attempt = df.sparkSession, new_batch()
    place = f"{path}/data/attempt={attempt}"
    df.write.partitionBy(partition).parquet(place)
    newest = _newest(spark, path)
    entries = dict(newest[0]) if newest else {}
    for value in replaced:
        entries.pop(_folder(value), None)
    written = spark.read.schema(df.schema).parquet(place).select(partition).distinct()
    entries.update({_folder(r[0]): attempt for r in written.collect()})  # one value a partition
    _commit(spark, path, attempt, entries, df.schema)


def drop_superseded(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of attempts that the newest commit does not name, dead ones included; returns their names.

    For times when nobody reads an older release or writes a new one.
    """
    newest = _newest(spark, path)
    if newest is None:
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName().removeprefix("attempt=") for f in files.listStatus(place)]
    gone = sorted(set(names) - set(newest[0].values()))
    for name in gone:
        remove_folder(spark, f"{path}/data/attempt={name}")
    return gone
