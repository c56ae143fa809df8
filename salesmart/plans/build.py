"""From delivered files to checked marts in one driver program."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import export, quality
from salesmart.operators.lookups import first_of_key
from salesmart.plans.starschema import FolderSource, StarSchema
from salesmart.sinks import tables as sinks
from salesmart.sources.contracts import RAW_COLUMNS, REFERENCE_KEYS, YEAR_COLUMN, YEAR_RANGE
from salesmart.sources.copy_dump import CopyDump
from salesmart.sources.csv_files import scan_csv_chunks
from salesmart.sources.geojson import scan_geojson_folder

RAW_CLUSTER = ("coddep", "codtypbien")


def exported(
    tables: Mapping[str, DataFrame], departments: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Dump tables reduced to what the raw layer keeps, optionally for some departments."""
    special = {
        "mutation": export.export_mutation,
        "parcelle": export.export_parcelle,
        "disposition_parcelle": export.export_disposition_parcelle,
    }
    kept = {
        name: special[name](df, departments)
        if name in special
        else export.export_simple(df, name, departments)
        for name, df in tables.items()
        if name in RAW_COLUMNS
    }
    return {
        name: first_of_key(df, REFERENCE_KEYS[name]) if name in REFERENCE_KEYS else df
        for name, df in kept.items()
    }


def write_raw(
    tables: Mapping[str, DataFrame], root: str, last_year: int | None = None
) -> dict[str, int]:
    """Raw layer below ``root``: sales by year, sorted by department and type; the rest whole.

    Years have partitions of their own up to ``last_year``, by default the current one.
    """
    rows = {}
    until = (last_year or datetime.date.today().year) + 1
    for name, df in tables.items():
        path = f"{root}/{name}"
        if name == "mutation":
            typed = df.withColumn(YEAR_COLUMN, F.col(YEAR_COLUMN).cast("long"))
            rows[name] = sinks.write_partitioned_clustered(
                typed, path, YEAR_COLUMN, RAW_CLUSTER, (YEAR_RANGE[0], until)
            )
        else:
            rows[name] = sinks.write_truncate(df, path)
    return rows


def publish_checked(spark: SparkSession, raw: str, root: str) -> dict[str, DataFrame]:
    """Star schema from a raw layer, with its quality report (declared tests and documented rules)
    written beside it.

    A failing check of severity ``error`` stops the run after the report is written.
    """
    models = StarSchema(spark, FolderSource(spark, raw)).publish(root)
    path = f"{root}/dq_report"
    checks = quality.dq_report(models).unionByName(quality.documented_report(models))
    sinks.write_truncate(checks, path)
    report = spark.read.parquet(path)
    quality.stop_on_error(report)
    return {**models, "dq_report": report}


def build_from_dump(
    spark: SparkSession,
    dumps: str,
    boundaries: str,
    root: str,
    departments: Sequence[str] | None = None,
    pattern: str = "*.sql",
) -> dict[str, DataFrame]:
    """Dump files and boundary files -> raw layer -> star schema."""
    dump = CopyDump(spark, dumps, pattern)
    found = {name: dump.table(name) for name in dump.tables()}
    return _build(spark, exported(found, departments), boundaries, root)


def build_from_csv(
    spark: SparkSession, folder: str, boundaries: str, root: str
) -> dict[str, DataFrame]:
    """CSV exports (flat or chunked) and boundary files -> raw layer -> star schema."""
    return _build(spark, scan_csv_chunks(spark, folder), boundaries, root)


def _build(
    spark: SparkSession, tables: Mapping[str, DataFrame], boundaries: str, root: str
) -> dict[str, DataFrame]:
    # before anything is replaced: a row of each table is enough
    missing = quality.dq_expected_tables({name: df.limit(1) for name, df in tables.items()}).filter("status = 'fail'").collect()
    if missing:
        raise quality.QualityError(
            "missing or empty: " + ", ".join(sorted(r.table_name for r in missing))
        )
    raw = f"{root}/raw"
    write_raw({**tables, **scan_geojson_folder(spark, boundaries)}, raw)
    return publish_checked(spark, raw, f"{root}/analytics")
