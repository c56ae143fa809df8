"""Export projections of the raw tables and the department filters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.projection import ewkb_position, with_latlon
from salesmart.functions.scalars import DEPARTMENT_CODE, array_first
from salesmart.sinks.tables import write_truncate
from salesmart.sources.contracts import (
    DEPARTMENT_TABLES,
    DISPOSITION_PARCELLE_DROPPED,
    MUTATION_ARRAYS,
    MUTATION_DROPPED,
    MUTATION_POINT,
    PARCELLE_DROPPED,
)


def check_departments(codes: Sequence[str]) -> list[str]:
    """The codes as a list; ValueError if one cannot be a department."""
    for code in codes:
        if not re.fullmatch(DEPARTMENT_CODE.strip("^$"), code):
            raise ValueError(f"not a department code: {code!r}")
    return list(codes)


def filter_departments(
    df: DataFrame, table: str, departments: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the given departments; no filter without codes or without the column.

    Rows without a department go, as they do at the end of a filtered load and export.
    """
    if not departments or table not in DEPARTMENT_TABLES or "coddep" not in df.columns:
        return df
    return df.filter(F.col("coddep").isin(check_departments(departments)))


def delete_outside_departments(
    spark: SparkSession, path: str, table: str, departments: Sequence[str] | None = None
) -> int:
    """Keep only the given departments in a stored table. Returns its rows afterwards.

    The rest is written beside it and takes its place when it is complete; without departments,
    or for a table without a department, nothing is written.
    """
    stored = spark.read.parquet(path)
    kept = filter_departments(stored, table, departments)
    return stored.count() if kept is stored else write_truncate(kept, path)


def point_to_latlon(df: DataFrame, point: str = MUTATION_POINT) -> DataFrame:
    """Replace a hex point geometry by latitude and longitude of its mean position."""
    located = df.withColumn("position", ewkb_position(F.col(point)))
    flat = located.withColumns({f"position_{c}": F.col(f"position.{c}") for c in ("x", "y", "srid")})
    placed = with_latlon(flat, "position_x", "position_y", "coddep", "position_srid")
    return placed.drop("position", "position_x", "position_y", "position_srid", point)


def export_mutation(df: DataFrame, departments: Sequence[str] | None = None) -> DataFrame:
    """Sales with list columns reduced to their first entry, position as latitude/longitude, and
    heavy or internal columns dropped; works on whatever columns are present."""
    kept = filter_departments(df, "mutation", departments).drop(*MUTATION_DROPPED)

    def out(name: str) -> Column:
        if name in MUTATION_ARRAYS:
            return array_first(F.col(name)).alias(MUTATION_ARRAYS[name])
        return F.col(name)

    reduced = kept.select(*[out(c) for c in kept.columns])
    return point_to_latlon(reduced) if MUTATION_POINT in reduced.columns else reduced


def export_parcelle(df: DataFrame, departments: Sequence[str] | None = None) -> DataFrame:
    return filter_departments(df, "parcelle", departments).drop(*PARCELLE_DROPPED)


def export_disposition_parcelle(
    df: DataFrame, departments: Sequence[str] | None = None
) -> DataFrame:
    return filter_departments(df, "disposition_parcelle", departments).drop(
        *DISPOSITION_PARCELLE_DROPPED
    )


def export_simple(
    df: DataFrame, table: str, departments: Sequence[str] | None = None
) -> DataFrame:
    return filter_departments(df, table, departments)
