"""Medians from small stored counts that merge over any choice of years and departments.

An amount, in whole cents, is counted in the band of its first ``DIGITS`` digits: 123,456.78 lies in
the band that starts at 123,000.00 and is 1,000.00 wide. Amounts under 10**DIGITS cents have a band
each. A band is at most 1 / 10**(DIGITS - 1) of its lower bound wide, so its middle is within half
of that of every amount in it, whatever the amounts are. Counts of a band add up, so what was stored
per year and department answers for any union of them with the same bound; what is stored grows with
the number of bands, at most 9 * 10**(DIGITS - 1) per power of ten, not with the sales.

Arithmetic is whole-number, so the same sales give the same bands in any order and on any engine.
Amounts are rounded to cents first. NULL and NaN are not counted; infinite amounts, and those whose
cents pass 18 digits, are an error. Where the two middle amounts of an even count differ in sign, the
bound holds for each of them, not for their mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.sinks.tables import write_truncate

DIGITS = 3
SCALE = 100  # cents

BAND, WIDTH, COUNT = "band_start", "band_width", "n"


def error_bound(digits: int = DIGITS) -> float:
    """Largest distance of an estimate to the true median, as a share of it (cents aside)."""
    return 0.5 / 10 ** (digits - 1)


def _cents(value: Column) -> Column:
    known = F.when(value.isNotNull() & ~F.isnan(value.cast("double")), value)
    return F.round(known.cast("decimal(38,6)") * SCALE, 0).cast("decimal(18,0)").cast("long")


def sketch(df: DataFrame, keys: Sequence[str], value: str, digits: int = DIGITS) -> DataFrame:
    """(keys..., band_start, band_width, n): signed lower bound towards zero, in cents."""
    cents = df.select(*keys, _cents(F.col(value)).alias("cents")).filter("cents IS NOT NULL")
    spare = F.greatest(F.length(F.abs("cents").cast("string")) - digits, F.lit(0))
    width = F.rpad(F.lit("1"), spare + 1, "0").cast("long")
    banded = cents.withColumn(WIDTH, width).withColumn(BAND, F.expr(f"cents div {WIDTH} * {WIDTH}"))
    return banded.groupBy(*keys, BAND, WIDTH).agg(F.count(F.lit(1)).alias(COUNT))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored counts with fewer keys, for the rows that a filter left."""
    return sketches.groupBy(*keys, BAND, WIDTH).agg(F.sum(COUNT).alias(COUNT))


def median(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys..., name, n): estimated median per group; the mean of both middle ones where n is even.

    Each group is its merged bands, a number that does not depend on the sales.
    """
    merged = merge(sketches, keys)
    group = W.partitionBy(*(keys or [F.lit(0)]))
    running = group.orderBy(BAND).rowsBetween(W.unboundedPreceding, W.currentRow)
    # middle of the whole cents of the band; bands of negative amounts reach away from zero
    sign = F.when(F.col(BAND) < 0, -1).otherwise(1)
    middle = (F.col(BAND) + sign * (F.col(WIDTH) - 1) / 2) / SCALE
    ranked = merged.select(
        *keys, middle.alias("middle"), COUNT,
        F.sum(COUNT).over(running).alias("until"), F.sum(COUNT).over(group).alias("total"),
    )

    def at(rank: str) -> Column:
        hit = F.expr(f"{rank} >= until - {COUNT} AND {rank} < until")
        return F.max(F.when(hit, F.col("middle")))

    both = (at("(total - 1) div 2") + at("total div 2")) / 2
    return ranked.groupBy(*keys).agg(both.alias(name), F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) > 0)


def write_sketch(df: DataFrame, keys: Sequence[str], value: str, path: str, digits: int = DIGITS) -> None:
    """Store the counts of a published fact beside it; a few files whatever the fact's size."""
    write_truncate(sketch(df, keys, value, digits), path)
