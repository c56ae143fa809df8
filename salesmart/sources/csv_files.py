"""CSV tables: one file, or many chunk files of one table, always read as text.

Types are never inferred: a code such as ``004`` or ``2A`` stays what it is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sources.contracts import MULTILINE_TABLES, YEAR_COLUMN, text_schema

LINEAGE = "source_file"

# An unquoted empty field is NULL, a quoted one an empty text. Spark only keeps them apart when
# its NULL marker is not the empty text itself; this one cannot be typed. Quotes are doubled.
CSV_OPTIONS = {"header": "true", "escape": '"', "nullValue": "\u0001"}


def _reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )


def _split_by_line_breaks(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """Files whose quoted fields hold line breaks, and the others.

    Such a file has a line with an odd number of quotes; the pass over the lines is split like any
    text. Only file names reach the driver.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(path)
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    broken = lines.filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("file")).distinct()
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select("path", F.col("_metadata.file_path").alias("file"))
    )
    marked = listing.join(broken.withColumn("whole", F.lit(True)), "file", "left")
    found = [(r.path, bool(r.whole)) for r in marked.select("path", "whole").toLocalIterator()]
    return [p for p, whole in found if whole], [p for p, whole in found if not whole]


def scan_csv_table(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    multiline: bool | None = None,
    lineage: bool = False,
) -> DataFrame:
    """All files of one table below ``path``.

    Column names come from the header of the first file; a file whose header differs in names or
    order is an error, since CSV fields bind by position. Quoted line breaks cost one task per
    file: ``multiline`` allows or forbids them for all files; by default the tables that may hold
    them are looked through, and only the files that do are read whole.
    """
    if multiline is None and table in MULTILINE_TABLES:
        whole, split = _split_by_line_breaks(spark, path)
        if whole and split:
            parts = [
                scan_csv_table(spark, files, table, kind, lineage)
                for files, kind in ((whole, True), (split, False))
            ]
            if parts[0].columns != parts[1].columns:
                raise ValueError(f"CSV headers of {table} differ: {parts[0].columns}, {parts[1].columns}")
            return parts[1].union(parts[0])
        multiline = bool(whole)
    reader = _reader(spark, bool(multiline))
    columns = reader.csv(path).columns
    df = (
        reader.schema(text_schema(columns))
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if lineage:
        df = df.select("*", F.col("_metadata.file_path").alias(LINEAGE))
    if table == "mutation" and YEAR_COLUMN in columns:
        df = df.withColumn(YEAR_COLUMN, F.col(YEAR_COLUMN).cast("long"))
    return df


def csv_files(spark: SparkSession, root: str) -> DataFrame:
    """Listing of CSV files below ``root`` with the table each belongs to.

    Flat ``root/t.csv`` and chunked ``root/t/chunk_001.csv`` both name table ``t``.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select("path", "length")
    )
    # the part behind the root, whatever scheme the listing puts in front of it
    place = re.sub(r"^\w+:(//[^/]*)?", "", root.rstrip("/"))
    inside = F.get(F.split("path", re.escape(place) + "/", 2), F.lit(1))
    entry = F.substring_index(inside, "/", 1)
    return listing.select(
        F.regexp_replace(entry, r"\.csv$", "").alias("table_name"),
        entry.alias("entry"),
        "path",
        "length",
    )


def scan_csv_chunks(spark: SparkSession, root: str, lineage: bool = False) -> dict[str, DataFrame]:
    """Every table found below ``root``, chunk files of one table read as one."""
    root = root.rstrip("/")
    entries = csv_files(spark, root).select("table_name", "entry").distinct()
    # one row per table and layout, so this list stays as short as the list of tables
    found: dict[str, list[str]] = {}
    for row in entries.toLocalIterator():
        found.setdefault(row.table_name, []).append(f"{root}/{row.entry}")
    return {
        name: scan_csv_table(spark, sorted(paths), name, lineage=lineage)
        for name, paths in sorted(found.items())
    }
