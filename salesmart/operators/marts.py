"""Fact and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import scalars
from salesmart.functions.geo import geojson_polygons, polygons_centroid
from salesmart.sources.contracts import CALENDAR_RANGE, FACT_COLUMNS


def fct_transactions(enriched: DataFrame, departments: DataFrame) -> DataFrame:
    """One row per sale with the department name and the price per built square metre.

    The name join carries no hint: Spark broadcasts the names while they are below its size
    threshold and otherwise sort-merges, where adaptive execution splits a hot department.
    """
    names = departments.select("department_code", "department_name")
    priced = enriched.withColumn(
        "price_per_sqm",
        scalars.price_per_sqm(F.col("transaction_price_eur"), F.col("total_built_area_sqm")),
    )
    return priced.join(names, "department_code", "left").select(
        *[F.col(source).alias(target) for target, source in FACT_COLUMNS]
    )


def distinct_pairs(mutations: DataFrame) -> DataFrame:
    """Distinct (commune on the deed, department) pairs."""
    return (
        mutations.filter(F.col("insee_code").isNotNull())
        .select(F.col("insee_code").alias("commune_code"), "department_code")
        .distinct()
    )


def all_commune_codes(parcelles: DataFrame, mutations: DataFrame) -> DataFrame:
    """Every parcel is one vote for its department; every distinct deed pair adds one vote."""
    parcel_votes = parcelles.filter(F.col("commune_code").isNotNull()).select(
        "commune_code", "department_code"
    )
    return parcel_votes.unionByName(distinct_pairs(mutations))


def mode_by_group(votes: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent ``value`` per ``group``; ties go to the smallest value.

    Counts are combined before the shuffle, so a group with very many votes costs one row per
    task; the pick runs on the few counted rows. NULL values take part and lose ties.
    """
    counted = votes.groupBy(group, value).agg(F.count(F.lit(1)).alias("votes"))
    ballot = F.struct((-F.col("votes")).alias("rank"), F.col(value).isNull().alias("no_value"), value)
    return counted.groupBy(group).agg(F.min(ballot)[value].alias(value))


def dim_communes(parcelles: DataFrame, mutations: DataFrame, names: DataFrame) -> DataFrame:
    """Observed communes with official name (or the code) and their most frequent department."""
    observed = mode_by_group(
        all_commune_codes(parcelles, mutations), "commune_code", "department_code"
    )
    return observed.join(
        names.select("commune_code", "commune_name"), "commune_code", "left"
    ).select(
        "commune_code",
        F.coalesce("commune_name", "commune_code").alias("commune_name"),
        "department_code",
    )


def dim_property_types(mutations: DataFrame) -> DataFrame:
    """Distinct (code, label) pairs of the sales with their level-1 class."""
    code = F.col("property_type_code")
    return (
        mutations.filter(code.isNotNull())
        .select("property_type_code", "property_type_label")
        .distinct()
        .select(
            "property_type_code",
            "property_type_label",
            scalars.level1_code(code).alias("property_type_level1"),
            scalars.level1_label(code).alias("property_type_level1_label"),
        )
    )


def dim_dates(days: DataFrame) -> DataFrame:
    """Calendar attributes for a table of days (column ``day``)."""
    day = F.col("day")
    return days.select(
        day.alias("date_key"), day.alias("full_date"), *scalars.calendar_columns(day)
    )


def date_spine(spark, start: str = CALENDAR_RANGE[0], end: str = CALENDAR_RANGE[1]) -> DataFrame:
    """One row per day of ``[start, end)``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("past")
    )
    return _days(bounds)


def date_spine_covering(sales: DataFrame, year: str = "transaction_year") -> DataFrame:
    """Every day of the calendar years that ``sales`` covers; the bounds are one combined row."""
    bounds = sales.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).select(
        F.make_date(F.col("lo").cast("int"), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.col("hi").cast("int") + 1, F.lit(1), F.lit(1)).alias("past"),
    )
    return _days(bounds)


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", F.date_sub("past", 1))).alias("day"))


def dim_geography(departments: DataFrame, communes: DataFrame) -> DataFrame:
    """Departments and communes in one table with a level mark and centroids.

    Staging has already replaced invalid boundaries by NULL, so each text is parsed just once.
    """
    upper = departments.select(
        F.col("department_code").alias("geo_code"),
        F.col("department_name").alias("geo_name"),
        F.lit("department").alias("geo_level"),
        "department_code",
        "department_name",
        "geometry",
    )
    lower = communes.select(
        F.col("commune_code").alias("geo_code"),
        F.col("commune_name").alias("geo_name"),
        F.lit("commune").alias("geo_level"),
        scalars.department_from_commune(F.col("commune_code")).alias("department_code"),
        F.lit(None).cast("string").alias("department_name"),
        "geometry",
    )
    centre = F.col("centre")
    return (
        upper.unionByName(lower)
        .withColumn("polygons", geojson_polygons(F.col("geometry")))
        .withColumn("centre", polygons_centroid(F.col("polygons")))
        .withColumns({"centroid_lat": centre["lat"], "centroid_lon": centre["lon"]})
        .drop("polygons", "centre")
    )
