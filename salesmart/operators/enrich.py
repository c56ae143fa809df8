"""Child tables aggregated to one row per sale, and the enriched sale.

Aggregating before joining keeps the sale grain and lets every child shuffle on ``mutation_id``
after a map-side combine, so a sale with very many children stays one small row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.serving import exact_sum

SALE = "mutation_id"


def arg_first(value: str, order: str) -> Column:
    """Value of the row that comes first in ``order``, also when that value is NULL."""
    return F.min(F.struct(F.col(order), F.col(value)))[value]


def disposition_agg(dispositions: DataFrame) -> DataFrame:
    return dispositions.groupBy(SALE).agg(
        F.count(F.lit(1)).alias("disposition_count_actual"),
        exact_sum("disposition_price_eur").alias("total_disposition_price_eur"),
    )


def local_agg(locals_: DataFrame) -> DataFrame:
    return locals_.groupBy(SALE).agg(
        F.max("main_room_count").alias("max_room_count"),
        F.sum("main_room_count").alias("total_room_count"),
        F.max("built_area_sqm").alias("max_local_built_area_sqm"),
    )


def parcelle_agg(parcelles: DataFrame) -> DataFrame:
    """First commune in parcel order, number of communes, land areas by use."""
    return parcelles.groupBy(SALE).agg(
        arg_first("commune_code", "disposition_parcel_id").alias("commune_code"),
        F.count_distinct("commune_code").alias("commune_count_parcelle"),
        F.sum("built_land_area_sqm").alias("total_built_land_area_sqm"),
        F.sum("agricultural_land_area_sqm").alias("total_agricultural_land_area_sqm"),
        F.sum("natural_land_area_sqm").alias("total_natural_land_area_sqm"),
    )


# Sale columns kept by the enriched model, in contract order.
SALE_COLUMNS = (
    "mutation_id", "mutation_opendata_id", "transaction_date", "transaction_year",
    "transaction_month", "mutation_nature_id", "mutation_nature_label", "is_vefa",
    "department_code", "commune_code", "insee_code", "transaction_price_eur",
    "property_type_code", "property_type_label", "total_built_area_sqm",
    "house_built_area_sqm", "apartment_built_area_sqm", "commercial_built_area_sqm",
    "land_area_sqm", "premises_count", "house_count", "apartment_count", "commercial_count",
    "outbuilding_count", "room_count", "total_room_count", "latitude", "longitude",
    "total_disposition_price_eur", "total_built_land_area_sqm",
    "total_agricultural_land_area_sqm", "total_natural_land_area_sqm",
)


def enriched(
    mutations: DataFrame, dispositions: DataFrame, locals_: DataFrame, parcelles: DataFrame
) -> DataFrame:
    """Sale left-joined with its three aggregated children.

    The cadastral commune wins over the one on the deed; sales without premises have zero rooms.
    """
    joined = (
        mutations.join(disposition_agg(dispositions), SALE, "left")
        .join(local_agg(locals_), SALE, "left")
        .join(parcelle_agg(parcelles), SALE, "left")
    )
    return joined.withColumns(
        {
            "commune_code": F.coalesce("commune_code", "insee_code"),
            "room_count": F.coalesce("max_room_count", F.lit(0)),
        }
    ).select(*SALE_COLUMNS)
