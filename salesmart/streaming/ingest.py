"""File-arrival ingestion, as resumable batches and as a stream.

Each attempt writes a folder of its own, ``table/batch_id=...``, and is recorded in the manifest
once its data is committed. Readers keep the (file, batch) pairs that the manifest names as newest,
so an attempt that died leaves rows that nobody sees, a repeated file replaces its earlier rows,
and a file that became empty loses them. No batch looks at the folders of others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from salesmart.operators.lookups import first_of_key
from salesmart.sources.contracts import REFERENCE_KEYS
from salesmart.sources.copy_dump import CopyDump
from salesmart.sources.csv_files import CSV_OPTIONS, scan_csv_table
from salesmart.streaming.manifest import (
    append_manifest,
    current_entries,
    new_batch,
    read_manifest,
    resume_anti_join,
)

SOURCE = "source_file"
BATCH = "batch_id"
DEFAULT_GROUP = 10


def _listing(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """Files with the name their rows carry (``source_file``) and a path to read them by."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(paths)
    )
    return found.select(
        F.col("_metadata.file_path").alias(SOURCE), "path", "length", "modificationTime"
    )


def discover(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Files below a folder, also in delivery subfolders, with the role their name gives them.

    The role only orders the work: set-up files first, then shared reference data, then sales.
    """
    return _listing(spark, folder, pattern).select(SOURCE, "path", "length", _role().alias("role"))


def _role() -> Column:
    lower = F.lower(F.element_at(F.split("path", "/"), -1))
    return (
        F.when(lower.contains("init"), "init")
        .when(lower.contains("annexe"), "reference")
        .otherwise("data")
    )


Reader = Callable[[SparkSession, Sequence[str]], dict[str, DataFrame]]


def csv_reader(table: str) -> Reader:
    """Batches of CSV files that all belong to one table."""
    def read(spark: SparkSession, files: Sequence[str]) -> dict[str, DataFrame]:
        return {table: scan_csv_table(spark, list(files), table, lineage=True)}

    return read


def dump_reader(spark: SparkSession, files: Sequence[str]) -> dict[str, DataFrame]:
    """Batches of dump files: every table found in them."""
    dump = CopyDump(spark, list(files), "*")  # whatever their names
    return {name: dump.table(name, lineage=True) for name in dump.tables()}


def _record(
    spark: SparkSession, listed: DataFrame, tables: dict[str, DataFrame], target: str, log: str
) -> DataFrame:
    """Write one batch as a folder of its own, count it by file, record it. Returns the counts."""
    batch, counts = new_batch(), None
    for name, df in tables.items():
        place = f"{target}/{name}/{BATCH}={batch}"
        df.write.parquet(place)
        # the files just written and one column of them
        stored = (
            spark.read.schema(df.schema)
            .parquet(place)
            .groupBy(SOURCE)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("table_name", F.lit(name))
        )
        counts = stored if counts is None else counts.unionByName(stored)
    zero = F.lit(0).cast("long").alias("row_count")
    if counts is None:
        counts = listed.select(SOURCE, zero, F.lit("").alias("table_name"))
    else:
        # a file without rows is recorded too: it is done, and its earlier rows are gone
        only = next(iter(tables)) if len(tables) == 1 else ""
        counts = listed.select(SOURCE).join(counts, SOURCE, "left").select(
            SOURCE,
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("table_name", F.lit(only)).alias("table_name"),
        )
    append_manifest(counts, batch, log)
    return counts


def ingest_files(
    spark: SparkSession,
    files: Sequence[str],
    target: str,
    manifest: str,
    read: Reader,
) -> DataFrame:
    """One batch of files, given by readable paths. Returns their counts.

    A file of no bytes, which Spark's readers pass over, has no rows: its earlier ones are gone.
    """
    empty = _without_bytes(spark, files)
    filled = [p for p in files if p not in empty]
    none = spark.createDataFrame([(name,) for name in empty.values()], f"{SOURCE} string")
    listed = _listing(spark, filled).select(SOURCE).unionByName(none) if filled else none
    return _record(spark, listed, read(spark, filled) if filled else {}, target, manifest)


def _without_bytes(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Path -> the name its rows would carry, of the empty ones among the files of a batch."""
    found = {}
    for path in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        if status.isFile() and status.getLen() == 0:
            # through its text, as Spark names files: file:/x, not file:///x
            found[path] = spark._jvm.org.apache.hadoop.fs.Path(status.getPath().toString()).toUri().toString()
    return found


def read_ingested(spark: SparkSession, target: str, table: str, manifest: str) -> DataFrame:
    """Rows of a table that the manifest vouches for; reference tables hold each key once."""
    found = spark.read.parquet(f"{target}/{table}")
    # the batch is text, whatever its name looks like
    schema = StructType([f for f in found.schema if f.name != BATCH]).add(BATCH, StringType())
    rows = spark.read.schema(schema).parquet(f"{target}/{table}")
    named = current_entries(read_manifest(spark, manifest)).filter(F.col("table_name") == table)
    kept = rows.join(named.select(SOURCE, BATCH), [SOURCE, BATCH], "left_semi")
    kept = kept.select(*[f.name for f in schema if f.name != BATCH])
    key = REFERENCE_KEYS.get(table)
    return first_of_key(kept, key) if key in kept.columns else kept


def chunk_cycle(
    spark: SparkSession,
    folder: str,
    target: str,
    manifest: str,
    read: Reader,
    pattern: str = "*.csv",
    group: int = DEFAULT_GROUP,
) -> int:
    """Ingest all files not yet in the manifest, ``group`` files per batch.

    Set-up and reference files go first. The group size may change between runs: progress is kept
    per file. Returns the number of batches run.
    """
    waiting = resume_anti_join(discover(spark, folder, pattern), read_manifest(spark, manifest))
    # file names only, as many as a file listing has; the data stays on the executors
    rows = [(r.role, r.path) for r in waiting.select("role", "path").toLocalIterator()]
    early = sorted((role, path) for role, path in rows if role != "data")
    data = sorted(path for role, path in rows if role == "data")
    batches = [*batched([path for _, path in early], group), *batched(data, group)]
    for files in batches:
        ingest_files(spark, files, target, manifest, read)
    return len(batches)


def reingest_subset(
    spark: SparkSession,
    files: Sequence[str],
    target: str,
    manifest: str,
    read: Reader,
) -> None:
    """Load the named files again; their earlier rows count no more, those of others stay."""
    ingest_files(spark, files, target, manifest, read)


def stream_cycle(
    spark: SparkSession,
    folder: str,
    target: str,
    manifest: str,
    checkpoint: str,
    read: Reader,
    pattern: str = "*.csv",
    files_per_trigger: int = DEFAULT_GROUP,
) -> int:
    """``chunk_cycle`` as a stream, for any reader: one micro-batch writes every table of its files.

    What streams is the file listing, names without contents; its offsets are the file log in
    ``checkpoint``. A micro-batch hands its files to ``read``, so a dump is cut into byte ranges of
    its own and each table is opened where its blocks lie. All tables of a micro-batch are one
    attempt and are recorded at once: one that dies on the way counts for nothing and runs again
    with the same files. Set-up and reference files are a stream of their own that ends before the
    data files start. A known file that changes is left to ``reingest_subset``, as in
    ``chunk_cycle``; after a lost checkpoint the files that the manifest names are not read again. A
    file of no bytes is not listed, by either.
    Returns the number of micro-batches that wrote something.
    """
    listing = spark.read.format("binaryFile").load(folder).schema
    done = 0

    def run(wanted: Column, place: str, limit: dict[str, int]) -> None:
        def keep(batch: DataFrame, _: int) -> None:
            nonlocal done
            waiting = resume_anti_join(batch.filter(wanted), read_manifest(spark, manifest))
            # names of one micro-batch
            files = sorted(r.path for r in waiting.select("path").collect())
            for group in batched(files, files_per_trigger):
                ingest_files(spark, group, target, manifest, read)
                done += 1

        query = (
            spark.readStream.format("binaryFile")
            .schema(listing)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .options(**limit)
            .load(folder)
            .select("path", F.col("_metadata.file_path").alias(SOURCE))  # contents are not read
            .writeStream.foreachBatch(keep)
            .option("checkpointLocation", place)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    early = _role() != "data"
    run(early, f"{checkpoint}/reference", {})
    run(~early, f"{checkpoint}/data", {"maxFilesPerTrigger": files_per_trigger})
    return done


def stream_ingest(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: StructType,
    target: str,
    manifest: str,
    checkpoint: str,
    files_per_trigger: int = DEFAULT_GROUP,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    multiline: bool = False,
) -> None:
    """The same ingestion as a stream: progress is the checkpoint, a group is a micro-batch.

    Micro-batches are recorded like batches, so one that runs again, even after the checkpoint was
    lost, replaces its rows. A file without rows shows up in no micro-batch; those that the manifest
    does not know in their present state are read once more and recorded if they are empty.
    """

    def reader(frames):
        return (
            frames.schema(schema)
            .options(**CSV_OPTIONS)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("multiLine", multiline)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv")
        )

    def keep(batch: DataFrame, _: int) -> None:
        # the files of the batch as they were delivered: one may lose all its rows in ``transform``
        files = batch.select(SOURCE).distinct()
        _record(spark, files, {table: transform(batch)}, target, manifest)

    source = reader(spark.readStream).option("maxFilesPerTrigger", files_per_trigger).csv(folder)
    query = (
        source.select("*", F.col("_metadata.file_path").alias(SOURCE))
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    known = current_entries(read_manifest(spark, manifest)).groupBy(SOURCE).agg(
        F.max("committed_at").alias("committed_at")
    )
    doubtful = _listing(spark, folder, "*.csv").join(known, SOURCE, "left").filter(
        "committed_at IS NULL OR modificationTime > committed_at"
    )
    # names only, and few: files without rows or changed since their batch
    paths = [r.path for r in doubtful.select("path").toLocalIterator()]
    if paths:
        filled = reader(spark.read).csv(paths).select(F.col("_metadata.file_path").alias(SOURCE))
        empty = _listing(spark, paths).join(filled.distinct(), SOURCE, "left_anti")
        empty = empty.select(
            SOURCE, F.lit(0).cast("long").alias("row_count"), F.lit(table).alias("table_name")
        )
        append_manifest(empty, new_batch(), manifest)
