"""Dashboard aggregates on the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.sinks.tables import in_years

PRICE = "transaction_price_eur"
PPSQM = "price_per_sqm"
TYPE = "property_type_label"
YEAR = "transaction_year"
DEPARTMENT = "department_code"
# A price has cents; 38 digits leave room for any number of sales.
MONEY = "decimal(20,2)"


def exact_sum(column: str):
    """Sum of prices in whole cents, the same for any order of rows; a double at the end."""
    return F.sum(F.col(column).cast(MONEY)).cast("double")


def _sales():
    return F.count(F.lit(1)).alias("transaction_count")


def _mean(column: str, name: str):
    # the last bits of a float sum depend on task order; six digits do not
    return F.round(F.avg(column), 6).alias(name)


def dash_filters(
    fact: DataFrame,
    years: tuple[int, int] | None = None,
    types: Sequence[str] | None = None,
    departments: Sequence[str] | None = None,
) -> DataFrame:
    """The page filters: year range, property types, departments; each optional."""
    if years:
        fact = in_years(fact, *years)
    if types:
        fact = fact.filter(F.col(TYPE).isin(*types))
    if departments:
        fact = fact.filter(F.col(DEPARTMENT).isin(*departments))
    return fact


def count_by_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy(TYPE).agg(_sales()).orderBy(F.desc("transaction_count"), TYPE)


def value_by_type(fact: DataFrame) -> DataFrame:
    total = exact_sum(PRICE).alias("total_price_eur")
    return fact.groupBy(TYPE).agg(total).orderBy(F.desc("total_price_eur"), TYPE)


def avg_price_by_year(fact: DataFrame) -> DataFrame:
    return fact.groupBy(YEAR).agg(_mean(PRICE, "avg_price_eur")).orderBy(YEAR)


def volume_by_year(fact: DataFrame) -> DataFrame:
    return fact.groupBy(YEAR).agg(_sales(), _mean(PRICE, "avg_price_eur")).orderBy(YEAR)


def ppsqm_by_department(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col(PPSQM).isNotNull())
        .groupBy(DEPARTMENT)
        .agg(_mean(PPSQM, "avg_price_per_sqm"), _sales())
        .orderBy(F.desc("avg_price_per_sqm"), DEPARTMENT)
    )


def rounded_avg_by_year(fact: DataFrame) -> DataFrame:
    """Sales and whole-euro average per year, with the number of all sales."""
    yearly = fact.groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.avg(PRICE)).alias("avg_price")
    )
    everything = F.sum("cnt").over(W.partitionBy(F.lit(0)))
    return yearly.select("*", everything.alias("total_rows")).orderBy(YEAR)


def top_types(fact: DataFrame, n: int = 10) -> DataFrame:
    return (
        fact.groupBy(TYPE)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), TYPE)
        .limit(n)
    )


def raw_count_by_department(raw: DataFrame, year: int) -> DataFrame:
    """Raw sales of one year per department."""
    return (
        in_years(raw, year, year, "anneemut")
        .groupBy("coddep")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "coddep")
    )


def year_department_stats(fact: DataFrame, year: int) -> DataFrame:
    return (
        in_years(fact, year, year)
        .groupBy(DEPARTMENT)
        .agg(_sales(), _mean(PRICE, "avg_price"))
        .orderBy(F.desc("transaction_count"), DEPARTMENT)
    )


def trend_for_segment(
    fact: DataFrame, first: int, last: int, department: str, type_code: str
) -> DataFrame:
    segment = in_years(fact, first, last).filter(
        (F.col(DEPARTMENT) == department) & (F.col("property_type_code") == type_code)
    )
    return (
        segment.groupBy(YEAR)
        .agg(_mean(PRICE, "avg_price"), F.count(F.lit(1)).alias("n"))
        .orderBy(YEAR)
    )


def exact_median(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Exact median per group without gathering a group in one task.

    Values are counted per (group, value), then summed into logarithmic bands. Running totals over
    the few bands show which bands hold the middle ranks; only those bands are sorted by value.
    The counts are shuffled once and serve both steps.
    """
    known = df.filter(F.col(value).isNotNull())
    counted = known.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    # finite doubles have logarithms within 746 of zero, so the three ranges of bands are apart
    size = F.floor(F.log(F.abs(F.col(value))) * 1024)
    band = (
        F.when(F.col(value) > 0, size)
        .when(F.col(value) < 0, F.lit(-(2**31)) - size)
        .otherwise(F.lit(-(2**30)))
    )
    # the join below asks for a band; asked for here as well, both steps read the very same counts
    counted = counted.withColumn("band", band).filter("band IS NOT NULL")

    by_band = W.partitionBy(group).orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    bands = (
        counted.groupBy(group, "band")
        .agg(F.sum("n").alias("in_band"))
        .select(
            group,
            "band",
            "in_band",
            F.coalesce(F.sum("in_band").over(by_band), F.lit(0)).alias("before"),
            F.sum("in_band").over(W.partitionBy(group)).alias("total"),
        )
        .withColumn("low", F.expr("(total - 1) div 2"))
        .withColumn("high", F.expr("total div 2"))
        .filter("high >= before and low < before + in_band")
        .select(F.col(group).alias("band_group"), F.col("band").alias("band_no"), "before", "low", "high")
    )
    in_middle = F.col(group).eqNullSafe(F.col("band_group")) & (F.col("band") == F.col("band_no"))
    inside = W.partitionBy(group, "band").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        counted.join(F.broadcast(bands), in_middle)  # two rows a group at most
        .withColumn(
            "first_rank", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
        )
        .withColumn("next_rank", F.col("first_rank") + F.col("n"))
    )

    def at(rank: str):
        hit = (F.col(rank) >= F.col("first_rank")) & (F.col(rank) < F.col("next_rank"))
        return F.max(F.when(hit, F.col(value)))

    return ranked.groupBy(group).agg(F.round((at("low") + at("high")) / 2, 4).alias(name))


def median_price_by_year(fact: DataFrame) -> DataFrame:
    return exact_median(fact, YEAR, PRICE, "median_price_eur").orderBy(YEAR)


def median_ppsqm_by_department(fact: DataFrame) -> DataFrame:
    return exact_median(fact, DEPARTMENT, PPSQM, "median_price_per_sqm").orderBy(DEPARTMENT)


def ppsqm_distribution(fact: DataFrame, width: float = 500.0, bands: int = 40) -> DataFrame:
    """Sales per price-per-m2 band of ``width`` euro; the last band is open."""
    slot = F.least(F.floor(F.col(PPSQM) / width), F.lit(bands))
    return (
        fact.filter(F.col(PPSQM).isNotNull())
        .groupBy((slot * width).cast("double").alias("band_start"))
        .agg(_sales())
        .orderBy("band_start")
    )


def volume_by_commune(fact: DataFrame, geography: DataFrame) -> DataFrame:
    """Sales per commune with name and centroid for a map; counted before the join."""
    counted = fact.groupBy("commune_code").agg(_sales())
    places = geography.filter(F.col("geo_level") == "commune").select(
        F.col("geo_code").alias("commune_code"), "geo_name", "centroid_lat", "centroid_lon"
    )
    return counted.join(places, "commune_code", "left")
