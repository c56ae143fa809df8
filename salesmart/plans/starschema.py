"""The models of the star schema, composed lazily over a source of raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import enrich, marts, staging
from salesmart.sinks import tables as sinks
from salesmart.sources.contracts import CALENDAR_RANGE, STAGED_FROM

# Child columns the enriched sale needs.
CHILD_COLUMNS = {
    "dispositions": ("mutation_id", "disposition_price_eur"),
    "locals": ("mutation_id", "main_room_count", "built_area_sqm"),
    "parcelles": (
        "mutation_id", "disposition_parcel_id", "commune_code", "built_land_area_sqm",
        "agricultural_land_area_sqm", "natural_land_area_sqm",
    ),
}
# Models by layer; those of one layer do not read each other.
LAYERS = (
    ("stg_mutations", "stg_dispositions", "stg_locals", "stg_parcelles", "stg_geo_departments",
     "stg_geo_communes"),
    ("int_transactions_enriched",),
    ("fct_transactions", "dim_communes", "dim_property_types", "dim_dates", "dim_geography"),
)
MODELS = tuple(name for layer in LAYERS for name in layer)
LAYER_NAMES = ("staging", "intermediate", "marts")
LAYER_KINDS = {"staging": "view", "intermediate": "view", "marts": "table"}
DEFAULT_NAMESPACE = "staging"
NAMESPACES: dict[str, str | None] = {"staging": None, "intermediate": None, "marts": "analytics"}
PARALLEL_WRITES = 4


class RawSource(Protocol):
    """Anything that hands out raw tables, whole or with some columns."""

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame: ...


class CatalogSource:
    """Raw tables of a database."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        df = self.spark.table(f"{self.database}.{name}")
        return df if columns is None else df.select(*columns)


class FolderSource:
    """Raw tables as Parquet folders below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/{name}")
        return df if columns is None else df.select(*columns)


class StarSchema:
    """Each method builds one model; nothing runs until a result is asked for."""

    def __init__(
        self,
        spark: SparkSession,
        source: RawSource,
        calendar: tuple[str, str] | None = CALENDAR_RANGE,
    ):
        """``calendar`` bounds the date dimension, ``[first, past)``; None: the years with sales."""
        self.spark = spark
        self.source = source
        self.calendar = calendar

    def staged(self, model: str, columns: Iterable[str] | None = None) -> DataFrame:
        """Staging columns of a model before its row filter, from just the raw columns needed."""
        raw = self.source.table(STAGED_FROM[model], staging.raw_columns(model, columns))
        return staging.stage(model, raw, columns)

    def stg_mutations(self, columns: Iterable[str] | None = None) -> DataFrame:
        if columns is None:
            return staging.price_positive(self.staged("mutations"))
        needed = [*columns, *({"transaction_price_eur"} - set(columns))]
        return staging.price_positive(self.staged("mutations", needed)).select(*columns)

    def stg_dispositions(self, columns: Iterable[str] | None = None) -> DataFrame:
        return self.staged("dispositions", columns)

    def stg_locals(self, columns: Iterable[str] | None = None) -> DataFrame:
        return self.staged("locals", columns)

    def stg_parcelles(self, columns: Iterable[str] | None = None) -> DataFrame:
        return self.staged("parcelles", columns)

    def stg_geo_departments(self, columns: Iterable[str] | None = None) -> DataFrame:
        return staging.not_null_filter(self.staged("geo_departments", columns), "department_code")

    def stg_geo_communes(self, columns: Iterable[str] | None = None) -> DataFrame:
        return staging.not_null_filter(self.staged("geo_communes", columns), "commune_code")

    def int_transactions_enriched(self) -> DataFrame:
        return enrich.enriched(
            self.stg_mutations(),
            self.stg_dispositions(CHILD_COLUMNS["dispositions"]),
            self.stg_locals(CHILD_COLUMNS["locals"]),
            self.stg_parcelles(CHILD_COLUMNS["parcelles"]),
        )

    def fct_transactions(self) -> DataFrame:
        return marts.fct_transactions(
            self.int_transactions_enriched(),
            self.stg_geo_departments(("department_code", "department_name")),
        )

    def dim_communes(self) -> DataFrame:
        return marts.dim_communes(
            self.stg_parcelles(("commune_code", "department_code")),
            self.stg_mutations(("insee_code", "department_code")),
            self.stg_geo_communes(("commune_code", "commune_name")),
        )

    def dim_property_types(self) -> DataFrame:
        return marts.dim_property_types(
            self.stg_mutations(("property_type_code", "property_type_label"))
        )

    def dim_dates(self) -> DataFrame:
        if self.calendar:
            return marts.dim_dates(marts.date_spine(self.spark, *self.calendar))
        return marts.dim_dates(marts.date_spine_covering(self.stg_mutations(("transaction_year",))))

    def dim_geography(self) -> DataFrame:
        return marts.dim_geography(self.stg_geo_departments(), self.stg_geo_communes())

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def publish(self, root: str, models: tuple[str, ...] = MODELS) -> dict[str, DataFrame]:
        """Write the models below ``root`` and hand back the written tables.

        Each model reads what was written before it, so a staging table is typed once and the
        enriched sale is joined once, however many models and checks use them.
        """
        written = WrittenModels(self.spark, root, self)
        for layer in LAYERS:
            wanted = [name for name in layer if name in models]
            with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
                # the writes of a layer share the cluster; list() waits and raises what failed
                list(pool.map(written.write, wanted))
            written.done.update(wanted)
        return {name: written.read(name) for name in written.done}


def register_models(
    spark: SparkSession,
    root: str,
    models: Iterable[str] = MODELS,
    default: str = DEFAULT_NAMESPACE,
    namespaces: Mapping[str, str | None] = NAMESPACES,
    kinds: Mapping[str, str] = LAYER_KINDS,
) -> dict[str, str]:
    """Enter the models written below ``root`` into the catalog; returns the name of each.

    A layer's own namespace is used verbatim, without one the default. Staging and intermediate
    models are views over their folder, marts are tables at their place. Models written again
    keep their entry; the fact's partitions are looked up anew.
    """
    names, wanted = {}, set(models)
    for layer, members in zip(LAYER_NAMES, LAYERS, strict=True):
        space = (namespaces.get(layer) or default).strip()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{space}`")
        for model in (m for m in members if m in wanted):
            name, place = f"`{space}`.`{model}`", f"{root.rstrip('/')}/{model}"
            if kinds[layer] == "view":
                spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{place}`")
            else:
                spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
                spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{place}'")
                if sinks.YEAR_BUCKET in spark.table(name).columns:
                    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            names[model] = f"{space}.{model}"
    return names


class WrittenModels(StarSchema):
    """Star schema that reads an upstream model from its table once that is written."""

    def __init__(self, spark: SparkSession, root: str, base: StarSchema):
        super().__init__(spark, base.source, base.calendar)
        self.root = root.rstrip("/")
        self.done: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str) -> int:
        if name == "fct_transactions":
            return sinks.write_partitioned_clustered(self.model(name), self.path(name))
        return sinks.write_truncate(self.model(name), self.path(name))

    def _stored(self, name: str, columns: Iterable[str] | None, build):
        if name not in self.done:
            return build(columns)
        df = self.read(name)
        return df if columns is None else df.select(*columns)

    def stg_mutations(self, columns=None):
        return self._stored("stg_mutations", columns, super().stg_mutations)

    def stg_dispositions(self, columns=None):
        return self._stored("stg_dispositions", columns, super().stg_dispositions)

    def stg_locals(self, columns=None):
        return self._stored("stg_locals", columns, super().stg_locals)

    def stg_parcelles(self, columns=None):
        return self._stored("stg_parcelles", columns, super().stg_parcelles)

    def stg_geo_departments(self, columns=None):
        return self._stored("stg_geo_departments", columns, super().stg_geo_departments)

    def stg_geo_communes(self, columns=None):
        return self._stored("stg_geo_communes", columns, super().stg_geo_communes)

    def int_transactions_enriched(self):
        name = "int_transactions_enriched"
        return self.read(name) if name in self.done else super().int_transactions_enriched()
