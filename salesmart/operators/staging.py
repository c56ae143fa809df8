"""Staging: rename, type and clean the raw tables, one row in, at most one row out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import scalars
from salesmart.functions.geo import geojson_parse
from salesmart.sources.contracts import STAGING


def _typed(kind: str, inputs: list[Column]) -> Column:
    if kind == "date":
        return scalars.safe_parse_date(inputs[0])
    if kind == "flag":
        return scalars.normalize_bool(inputs[0])
    if kind == "commune":
        return scalars.commune_code(*inputs)
    if kind == "geojson":
        return geojson_parse(inputs[0])
    return inputs[0].cast(kind)


def raw_columns(model: str, columns: Iterable[str] | None = None) -> list[str]:
    """Raw columns that the wanted staging columns are made of."""
    wanted = None if columns is None else set(columns)
    names: list[str] = []
    for output, inputs, _ in STAGING[model]:
        if wanted is None or output in wanted:
            names += [c for c in inputs.split() if c not in names]
    return names


def stage(model: str, raw: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Typed columns of one staging model, all of them or the ones asked for."""
    wanted = None if columns is None else set(columns)
    return raw.select(
        *[
            _typed(kind, [F.col(c) for c in inputs.split()]).alias(output)
            for output, inputs, kind in STAGING[model]
            if wanted is None or output in wanted
        ]
    )


def price_positive(staged: DataFrame, column: str = "transaction_price_eur") -> DataFrame:
    """Market sales: price above zero; NULL and NaN prices go."""
    return staged.filter(scalars.positive_price(F.col(column)))


def not_null_filter(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df
