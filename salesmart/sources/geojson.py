"""Boundary files: one row per feature of a FeatureCollection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sources.contracts import GEOJSON_FILES, GEOJSON_PROPERTIES

_SCHEMA = (
    "features array<struct<properties:struct<"
    + ",".join(f"{p}:string" for p in GEOJSON_PROPERTIES)
    + ">,geometry:string>>"
)


def table_for_file(name: str) -> str | None:
    """Target table of a known boundary file name; None for files to skip."""
    return GEOJSON_FILES.get(name.rsplit("/", 1)[-1])


def scan_geojson(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Known properties as text columns and the geometry as JSON text.

    Undeclared properties are dropped by the reader, a document without features gives no rows,
    and a feature without properties keeps its row. A document is read by one task; boundary
    documents are bounded by geography, not by the number of sales.
    """
    documents = spark.read.schema(_SCHEMA).option("multiLine", True).json(path)
    feature = F.col("feature")
    geometry = feature["geometry"]
    return documents.select(F.explode("features").alias("feature")).select(
        *[feature["properties"][p].alias(p) for p in GEOJSON_PROPERTIES],
        F.when(~geometry.isin("", "{}"), geometry).alias("geometry"),
    )


def scan_geojson_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Boundary tables found in a folder; files with unknown names are skipped."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.geojson").load(folder)
    ).select("path")
    paths: dict[str, list[str]] = {}
    for row in listing.toLocalIterator():
        table = table_for_file(row.path)
        if table:
            paths.setdefault(table, []).append(row.path)
    return {table: scan_geojson(spark, sorted(found)) for table, found in sorted(paths.items())}
