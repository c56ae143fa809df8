"""Scalar rules shared by staging, marts and exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a true flag, overseas prefix, level-1 labels.
TRUE_SPELLINGS = ("T", "TRUE", "1")
OVERSEAS_PREFIX = "97"
LEVEL1_LABELS = {"1": "Built property", "2": "Unbuilt land"}
LEVEL1_OTHER = "Other"

# Date text; the 101 department codes (01-95 without 20, 2A/2B, five overseas), and
# those with one overseas territory that deliveries may also name.
DATE_FORMAT = "yyyy-M-d"
DEPARTMENTS = tuple(
    sorted(
        [f"{n:02d}" for n in range(1, 96) if n != 20]
        + ["2A", "2B", "971", "972", "973", "974", "976"]
    )
)
OFFICIAL_DEPARTMENT = r"^(?:0[1-9]|1[0-9]|2[1-9AB]|[3-8][0-9]|9[0-5]|97[1-46])$"
DEPARTMENT_CODE = r"^(?:0[1-9]|1[0-9]|2[1-9AB]|[3-8][0-9]|9[0-5]|97[1-6])$"


def safe_parse_date(text: Column) -> Column:
    """``2023-06-15`` -> date; anything unparsable -> NULL, the row stays."""
    return F.try_to_date(text, DATE_FORMAT)


def normalize_bool(text: Column) -> Column:
    """True for the accepted spellings in any case, false for all else including NULL."""
    return F.coalesce(F.upper(text).isin(*TRUE_SPELLINGS), F.lit(False))


def commune_code(department: Column, suffix: Column) -> Column:
    """Department followed by the commune suffix; NULL if either is NULL."""
    return F.concat(department, suffix)


def department_from_commune(code: Column) -> Column:
    """Overseas communes carry a three-character department, all others two."""
    width = F.when(code.startswith(OVERSEAS_PREFIX), F.lit(3)).otherwise(F.lit(2))
    return F.substring(code, F.lit(1), width)


def level1_code(type_code: Column) -> Column:
    return F.substring(type_code, 1, 1)


def level1_label(type_code: Column) -> Column:
    """Coarse class of a hierarchical property type code."""
    first = level1_code(type_code)
    label = F.lit(LEVEL1_OTHER)
    for code, text in LEVEL1_LABELS.items():
        label = F.when(first == code, F.lit(text)).otherwise(label)
    return label


def price_per_sqm(price: Column, area: Column) -> Column:
    """NULL for a NULL or zero area instead of an error or infinity."""
    return F.try_divide(price, F.nullif(area, F.lit(0.0)))


def positive_price(price: Column) -> Column:
    """Market sales only. Spark orders NaN above every number, so it is excluded by name."""
    return (price > 0) & ~F.isnan(price)


def array_first(values: Column) -> Column:
    """First element; NULL for an empty or NULL array."""
    return F.get(values, F.lit(0))


# One element: quoted with escapes, or bare. No alternative is repeated, so matching needs no depth
# that grows with the text.
_PG_ELEMENT = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^",]++'


def pg_array(text: Column) -> Column:
    """Array literal text such as ``{01004,"a b",NULL}`` -> array of strings, in linear time.

    Only a bare NULL is NULL. The text must be an array literal, braces included.
    """
    body = F.substring(text, F.lit(2), F.length(text) - 2)

    def value(e: Column) -> Column:
        inner = F.substring(e, F.lit(2), F.length(e) - 2)
        plain = F.when(F.contains(inner, F.lit("\\")), F.regexp_replace(inner, r"(?s)\\(.)", "$1")).otherwise(inner)
        bare = F.when(F.upper(e) != "NULL", e)
        return F.when(e.startswith('"'), plain).otherwise(bare)

    simple = F.transform(F.split(body, ","), lambda e: F.when(F.upper(e) != "NULL", e))
    quoted = F.transform(F.regexp_extract_all(body, F.lit(_PG_ELEMENT), F.lit(0)), value)
    elements = F.when(F.contains(body, F.lit('"')), quoted).otherwise(simple)
    empty = F.array().cast("array<string>")
    return F.when(text.isNotNull(), F.when(body == "", empty).otherwise(elements))


def calendar_columns(day: Column) -> list[Column]:
    """Calendar attributes of one date; weeks start on Sunday = 1."""
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    ]
