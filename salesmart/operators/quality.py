"""Declarative data-quality checks and their report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.scalars import DEPARTMENTS, OFFICIAL_DEPARTMENT
from salesmart.operators.lookups import fk_anti_join
from salesmart.sources.contracts import (
    DATE_RULE,
    MINIMUM_FEATURES,
    PRINCIPAL_TABLES,
    REFERENCE_TABLES,
    YEAR_RULE,
)


@dataclass(frozen=True)
class Check:
    """One declared test; ``warn`` reports without failing the run."""

    model: str
    column: str
    test: str
    severity: str = "error"
    to: str = ""
    field: str = ""
    values: tuple[str, ...] = ()


# The 63 declared tests (13 unique, 40 not_null, 7 relationships, 2 accepted_values,
# 1 expression) by model and column.
UNIQUE = {
    "stg_mutations": ("mutation_id",),
    "stg_dispositions": ("disposition_id",),
    "stg_locals": ("local_id",),
    "stg_parcelles": ("disposition_parcel_id",),
    "stg_geo_departments": ("department_code",),
    "stg_geo_communes": ("commune_code",),
    "int_transactions_enriched": ("mutation_id",),
    "fct_transactions": ("transaction_id", "mutation_id"),
    "dim_communes": ("commune_code",),
    "dim_property_types": ("property_type_code",),
    "dim_dates": ("date_key",),
    "dim_geography": ("geo_code",),
}
NOT_NULL = {
    "stg_mutations": (
        "mutation_id", "mutation_opendata_id", "transaction_year", "department_code",
        "transaction_price_eur",
    ),
    "stg_dispositions": ("disposition_id", "mutation_id"),
    "stg_locals": ("local_id", "mutation_id"),
    "stg_parcelles": ("disposition_parcel_id", "mutation_id", "commune_code"),
    "stg_geo_departments": ("department_code", "department_name"),
    "stg_geo_communes": ("commune_code", "commune_name"),
    "int_transactions_enriched": (
        "mutation_id", "transaction_year", "department_code", "transaction_price_eur",
    ),
    "fct_transactions": (
        "transaction_id", "mutation_id", "transaction_year", "department_code",
        "transaction_price_eur",
    ),
    "dim_communes": ("commune_code", "commune_name", "department_code"),
    "dim_property_types": ("property_type_code",),
    "dim_dates": (
        "date_key", "full_date", "year", "quarter", "month", "month_name", "day_of_week",
    ),
    "dim_geography": ("geo_code", "geo_name", "geo_level", "department_code"),
}
RELATIONSHIPS = (
    ("stg_dispositions", "mutation_id", "stg_mutations", "mutation_id", "warn"),
    ("stg_locals", "mutation_id", "stg_mutations", "mutation_id", "warn"),
    ("stg_parcelles", "mutation_id", "stg_mutations", "mutation_id", "warn"),
    ("fct_transactions", "transaction_date", "dim_dates", "date_key", "warn"),
    ("fct_transactions", "department_code", "dim_geography", "geo_code", "error"),
    ("fct_transactions", "commune_code", "dim_communes", "commune_code", "warn"),
    ("fct_transactions", "property_type_code", "dim_property_types", "property_type_code", "error"),
)
ACCEPTED_VALUES = (
    ("dim_property_types", "property_type_level1", ("1", "2"), "warn"),
    ("dim_geography", "geo_level", ("department", "commune"), "error"),
)
EXPRESSIONS = (("fct_transactions", "transaction_price_eur", "> 0"),)


def declared_checks() -> list[Check]:
    checks = [Check(m, c, "unique") for m, cols in UNIQUE.items() for c in cols]
    checks += [Check(m, c, "not_null") for m, cols in NOT_NULL.items() for c in cols]
    checks += [
        Check(m, c, "relationships", severity, to, field)
        for m, c, to, field, severity in RELATIONSHIPS
    ]
    checks += [
        Check(m, c, "accepted_values", severity, values=values)
        for m, c, values, severity in ACCEPTED_VALUES
    ]
    checks += [Check(m, c, "expression", values=(e,)) for m, c, e in EXPRESSIONS]
    return checks


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL rows of many columns in one pass: one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(counts, {c: F.col(c) for c in columns}, "column_name")


def dq_relationships(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Child keys without parent, with their rows."""
    return fk_anti_join(child, column, parent, field)


def dq_accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Non-NULL values outside the list, with their rows."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def dq_expression(df: DataFrame, column: str, expression: str) -> DataFrame:
    """Rows for which ``column expression`` is false; NULL does not fail."""
    return df.agg(F.count_if(F.expr(f"NOT ({column} {expression})")).alias("failures"))


def _unpivot(row: DataFrame, values: Mapping[str, Column], name: str) -> DataFrame:
    """One aggregated row -> one row per entry."""
    cells = [F.struct(F.lit(k).alias(name), v.alias("failures")) for k, v in values.items()]
    return row.select(F.inline(F.array(*cells)))


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks that look at single rows of one model: one scan, one aggregated row."""
    def failing(check: Check) -> Column:
        if check.test == "not_null":
            return F.count_if(F.col(check.column).isNull())
        return F.count_if(F.expr(f"NOT ({check.column} {check.values[0]})"))

    counts = df.agg(*[failing(c).alias(f"c{i}") for i, c in enumerate(checks)])
    cells = [
        F.struct(
            F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column"),
            F.lit(c.test).alias("test"),
            F.lit(c.severity).alias("severity"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*cells)))


_OWN = 0  # slot of a domain's own values; its relationships have slots from 1
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _domain(check: Check) -> str:
    """The values that a set check is about: a column that must be unique or is referred to;
    unexpected values are a domain of their own."""
    if check.test == "relationships":
        return f"{check.to}.{check.field}"
    return f"{'values of ' if check.test == 'accepted_values' else ''}{check.model}.{check.column}"


def _cells(models: Mapping[str, DataFrame], checks: list[Check]) -> tuple[dict[str, dict[tuple[str, int], Column]], dict[int, int]]:
    """Model -> (domain, slot) -> the values it gives, and the slot of each relationship's number.

    A domain's own model gives its values in slot 0; each relationship gives the child's values in
    a slot of its own.
    """
    cells: dict[str, dict[tuple[str, int], Column]] = {}
    slots: dict[int, int] = {}
    taken: dict[str, int] = {}
    for number, check in enumerate(checks):
        domain, value = _domain(check), models[check.model][check.column]
        if check.test == "relationships":
            taken[domain] = slots[number] = taken.get(domain, _OWN) + 1
            cells.setdefault(check.to, {})[domain, _OWN] = models[check.to][check.field]
            cells.setdefault(check.model, {})[domain, slots[number]] = value
        else:
            kept = F.when(~value.isin(*check.values), value) if check.test == "accepted_values" else value
            cells.setdefault(check.model, {})[domain, _OWN] = kept
    return cells, slots


def _keyed(models: Mapping[str, DataFrame], cells: Mapping[str, Mapping[tuple[str, int], Column]], numbers: Mapping[str, int]) -> DataFrame:
    """(domain, slot, whole, text) rows, one scan a model: keys of a domain are whole numbers if
    they are so (or dates) wherever they come from, else text."""
    typed = {m: models[m].select(*[c.alias(f"c{i}") for i, c in enumerate(own.values())]) for m, own in cells.items()}
    kinds: dict[str, set[str]] = {}
    for m, own in cells.items():
        for (domain, _), (_, kind) in zip(own, typed[m].dtypes, strict=True):
            kinds.setdefault(domain, set()).add("whole" if kind in _WHOLE else kind)

    def cell(domain: str, slot: int, name: str) -> Column:
        value, none = F.col(name), F.lit(None)
        if kinds[domain] == {"whole"}:
            whole, text = value.cast("long"), none.cast("string")
        elif kinds[domain] == {"date"}:
            whole, text = F.unix_date(value).cast("long"), none.cast("string")
        else:
            whole, text = none.cast("long"), value.cast("string")
        return F.struct(F.lit(numbers[domain]).alias("domain"), F.lit(slot).alias("slot"), whole.alias("whole"), text.alias("text"))

    parts = [
        typed[m].select(F.inline(F.array(*[cell(*key, f"c{i}") for i, key in enumerate(own)])))
        for m, own in cells.items()
    ]
    return reduce(DataFrame.unionByName, parts).filter("whole IS NOT NULL OR text IS NOT NULL")


def _set_checks(models: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All checks over groups of rows (repeated values, orphans, unexpected values): every model is
    scanned once, and one two-phase grouping by (domain, key) serves them all. Nearly every key is
    a row of that shuffle, so its rows are short: numbers, and as many counters as a domain needs."""
    cells, slots = _cells(models, checks)
    numbers = {d: n for n, d in enumerate(dict.fromkeys(map(_domain, checks)))}
    links = range(1, max(slots.values(), default=_OWN) + 1)
    per_key = _keyed(models, cells, numbers).groupBy("domain", "whole", "text").agg(
        *[F.count_if(F.col("slot") == k).alias(f"n{k}") for k in (_OWN, *links)]
    )
    own = F.col(f"n{_OWN}")
    totals = per_key.groupBy("domain").agg(
        F.count_if(own > 1).alias("repeated"),
        F.count_if(own > 0).alias("present"),
        *[F.sum(F.when(own == 0, F.col(f"n{k}")).otherwise(0)).alias(f"n{k}") for k in links],
    )
    rows = []
    for number, check in enumerate(checks):
        found = {"relationships": f"n{slots.get(number)}", "accepted_values": "present"}.get(check.test, "repeated")
        # a domain without any key has no row, and no failure
        rows.append(
            F.struct(
                F.lit(check.model).alias("model"),
                F.lit(check.column).alias("column"),
                F.lit(check.test).alias("test"),
                F.lit(check.severity).alias("severity"),
                F.sum(F.when(F.col("domain") == numbers[_domain(check)], F.col(found)).otherwise(0)).alias("failures"),
            )
        )
    single = totals.agg(F.array(*rows).alias("checks"))
    out = single.select(F.inline("checks"))
    return out.withColumn("failures", F.coalesce("failures", F.lit(0)))


def dq_report(models: Mapping[str, DataFrame], checks: Sequence[Check] | None = None) -> DataFrame:
    """One row per check: model, column, test, severity, failures, status.

    Give it written tables: a model is scanned at most twice, for its row checks and for its keys.
    """
    checks = declared_checks() if checks is None else list(checks)
    row_tests = ("not_null", "expression")
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        single = [c for c in checks if c.model == model and c.test in row_tests]
        if single:
            parts.append(_row_checks(models[model], single))
    grouped = [c for c in checks if c.test not in row_tests]
    if grouped:
        parts.append(_set_checks(models, grouped))
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


class QualityError(Exception):
    """A check of severity ``error`` has failing rows."""


def stop_on_error(report: DataFrame) -> None:
    """Raise if the run must stop; the report has one row per check."""
    bad = report.filter("status = 'fail'").collect()
    if bad:
        raise QualityError(
            "; ".join(f"{r.test} {r.model}.{r.column}: {r.failures} failing" for r in bad)
        )


# --- documented rules without a declared test -------------------------------------------------


def dq_date_range(df: DataFrame, column: str, bounds: tuple[str, str] = DATE_RULE) -> DataFrame:
    """Dates outside the documented period, and dates that could not be read."""
    inside = F.col(column).between(F.lit(bounds[0]).cast("date"), F.lit(bounds[1]).cast("date"))
    return df.agg(
        F.count_if(~inside).alias("outside"), F.count_if(F.col(column).isNull()).alias("missing")
    )


def dq_year_range(df: DataFrame, column: str, bounds: tuple[int, int] = YEAR_RULE) -> DataFrame:
    return df.agg(F.count_if(~F.col(column).between(*bounds)).alias("outside"))


def dq_fk_chain(links: DataFrame, dispositions: DataFrame, locals_: DataFrame) -> DataFrame:
    """Orphans along parcel link -> disposition and premises -> parcel link."""
    steps = (
        ("parcel_link_to_disposition", links, "disposition_id", dispositions, "disposition_id"),
        ("local_to_parcel_link", locals_, "disposition_parcel_id", links, "disposition_parcel_id"),
    )
    out = [
        fk_anti_join(child, key, parent, field).agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
        ).select(F.lit(name).alias("step"), "orphan_keys", "orphan_rows")
        for name, child, key, parent, field in steps
    ]
    return reduce(DataFrame.unionByName, out)


def dq_department_codes(df: DataFrame, column: str = "department_code") -> DataFrame:
    """Department codes that are not valid, with their rows."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(~F.coalesce(F.col("value").rlike(OFFICIAL_DEPARTMENT), F.lit(False)))
    )


def dq_type_not_null(df: DataFrame, column: str = "property_type_code") -> DataFrame:
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("failures"), F.count(F.lit(1)).alias("row_count")
    )


def dq_geometry_null_rate(df: DataFrame, column: str, by: str) -> DataFrame:
    """Share of rows without a position, per group."""
    missing = F.count_if(F.col(column).isNull())
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        missing.alias("missing"),
        F.round(missing / F.count(F.lit(1)), 6).alias("null_rate"),
    )


def dq_coverage(
    used: DataFrame, used_key: str, official: DataFrame, official_key: str
) -> DataFrame:
    """Codes known on one side only: in the sales but not official, or official but never sold."""
    # one row per code and side, so each side is read once and hot codes are single rows
    left = used.select(F.col(used_key).alias("code")).distinct().withColumn("sold", F.lit(True))
    right = official.select(F.col(official_key).alias("code")).distinct().withColumn(
        "official", F.lit(True)
    )
    both = left.filter("code IS NOT NULL").join(right.filter("code IS NOT NULL"), "code", "full_outer")
    gap = F.when(F.col("official").isNull(), "not_official").when(F.col("sold").isNull(), "not_sold")
    return both.select("code", gap.alias("gap")).filter("gap IS NOT NULL")


def dq_missing_departments(df: DataFrame, column: str = "department_code") -> DataFrame:
    """Departments of the official list without a row."""
    listed = df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, DEPARTMENTS))).alias("department_code")
    )
    present = df.select(F.col(column).alias("department_code")).distinct()
    return listed.join(present, "department_code", "left_anti")


def dq_code_length(df: DataFrame, column: str = "commune_code", length: int = 5) -> DataFrame:
    """Commune codes whose length differs from the official one."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.length("value") != length)
    )


def dq_min_features(tables: Mapping[str, DataFrame], minimum: Mapping[str, int] | None = None) -> DataFrame:
    """Features per boundary table against the least number expected."""
    minimum = MINIMUM_FEATURES if minimum is None else minimum
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("features")).select(
            F.lit(name).alias("table_name"),
            "features",
            F.lit(least).cast("long").alias("minimum"),
            (F.col("features") >= least).alias("ok"),
        )
        for name, least in minimum.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_expected_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Principal tables must exist (sales also with rows); missing reference tables only warn."""
    expected = [(t, "error") for t in PRINCIPAL_TABLES] + [(t, "warn") for t in REFERENCE_TABLES]
    parts = []
    for name, severity in expected:
        df = tables.get(name)
        if df is None:
            any_table = next(iter(tables.values()))
            rows = any_table.agg(F.lit(None).cast("long").alias("row_count"))
        else:
            rows = df.agg(F.count(F.lit(1)).alias("row_count"))
        missing = F.col("row_count").isNull()
        if name == "mutation":
            missing = missing | (F.col("row_count") == 0)
        parts.append(
            rows.select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.when(missing, "fail" if severity == "error" else "warn")
                .otherwise("pass")
                .alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def documented_report(models: Mapping[str, DataFrame]) -> DataFrame:
    """The documented rules over written models, in the shape of ``dq_report``; none stops a run,
    since a build of some departments breaks the coverage rules by design."""
    sales, communes = models["stg_mutations"], models["stg_geo_communes"]
    bounds = dq_date_range(sales, "transaction_date").select(F.col("outside") + F.col("missing"))
    count = F.count(F.lit(1))
    rules = (
        ("stg_mutations", "transaction_date", "date_range", bounds),
        ("stg_mutations", "transaction_year", "year_range", dq_year_range(sales, "transaction_year")),
        ("stg_mutations", "department_code", "department_codes", dq_department_codes(sales).agg(F.coalesce(F.sum("row_count"), F.lit(0)))),
        ("stg_mutations", "property_type_code", "type_not_null", dq_type_not_null(sales).select("failures")),
        ("stg_geo_departments", "department_code", "all_departments", dq_missing_departments(models["stg_geo_departments"]).agg(count)),
        ("stg_geo_communes", "commune_code", "commune_coverage", dq_coverage(models["stg_parcelles"], "commune_code", communes, "commune_code").filter("gap = 'not_official'").agg(count)),
        *(
            (name, "*", "min_features", models[name].agg(F.greatest(F.lit(least) - count, F.lit(0))))
            for name, least in (("stg_geo_departments", MINIMUM_FEATURES["geo_departments"]), ("stg_geo_communes", MINIMUM_FEATURES["geo_communes"]))
        ),
    )
    parts = [
        failures.toDF("failures").select(
            F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(test).alias("test"),
            F.lit("warn").alias("severity"), F.col("failures").cast("long").alias("failures"),
            F.when(F.col("failures") == 0, "pass").otherwise("warn").alias("status"),
        )
        for model, column, test, failures in rules
    ]
    return reduce(DataFrame.unionByName, parts)
