"""Registered queries: every operator run over the whole trial tables of one folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import geo, scalars
from salesmart.operators import enrich, export, lookups, marts, quality, serving, sketches, staging
from salesmart.plans.starschema import StarSchema
from salesmart.session import new_folder
from salesmart.sinks import clustered
from salesmart.sinks import tables as sinks
from salesmart.sinks.releases import read_release
from salesmart.sources import csv_files, geojson
from salesmart.sources.contracts import (
    MUTATION_POINT,
    PRINCIPAL_TABLES,
    REFERENCE_TABLES,
    SIMPLE_EXPORT_TABLES,
    SOURCE_TABLES,
    raw_schema,
)
from salesmart.sources.copy_dump import CopyDump, write_copy_dump
from salesmart.sources.trial_points import point_ewkb, srid_of
from salesmart.sources.trial_tables import TrialTables, raw_columns
from salesmart.streaming import ingest, manifest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def star(spark: SparkSession, folder: str) -> StarSchema:
    return StarSchema(spark, TrialTables(spark, folder))


# Marts are written once per session and state of the input; the serving queries read them. A
# folder has one entry: when its files change, the new state takes the place of the old one.
_WRITTEN: dict[tuple[str, str, str], tuple[str, dict[str, DataFrame]]] = {}


def _state(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the input files, as the file system lists them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def _written(spark: SparkSession, folder: str, what: str, models: tuple[str, ...] | None):
    key, state = (spark.sparkContext.applicationId, folder, what), _state(spark, folder)
    if _WRITTEN.get(key, ("",))[0] != state:
        root = new_folder(spark, f"star-{what}")
        schema = star(spark, folder)
        made = schema.publish(root) if models is None else schema.publish(root, models)
        _WRITTEN[key] = (state, made)
    return _WRITTEN[key][1]


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """The published fact: partitioned by year, sorted by department and type."""
    return _written(spark, folder, "fact", ("fct_transactions",))["fct_transactions"]


def all_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return _written(spark, folder, "all", None)


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


# --- sources ----------------------------------------------------------------------------------


@query
def scan_csv_table(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "csv")
    sinks.write_csv_export(TrialTables(spark, folder).table("disposition"), f"{root}/disposition.csv")
    return csv_files.scan_csv_table(spark, f"{root}/disposition.csv", "disposition")


@query
def scan_csv_chunks(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "chunks")
    sales = TrialTables(spark, folder).table("mutation")
    early = F.col("anneemut") < 2020
    sinks.write_csv_export(sales.filter(early), f"{root}/mutation/chunk_001.csv")
    sinks.write_csv_export(sales.filter(~early), f"{root}/mutation/chunk_002.csv")
    return csv_files.scan_csv_chunks(spark, root)["mutation"]


@query
def scan_geojson(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "geojson")
    shapes = TrialTables(spark, folder).table("geo_communes")
    geometry = F.coalesce("geometry", F.lit("null"))
    names = F.to_json(F.struct("code", "nom", "departement", "region", "epci"))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), names, F.lit(',"geometry":'), geometry, F.lit("}")
    )
    # one document per department; a department has at most a thousand commune codes
    documents = shapes.groupBy("departement").agg(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.array_join(F.collect_list(feature), ","),
            F.lit("]}"),
        ).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(root)
    return geojson.scan_geojson(spark, root)


@query
def scan_copy_dump(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "dump")
    trial = TrialTables(spark, folder)
    sales = trial.table("mutation_dump").drop("point_x", "point_y")
    write_copy_dump(sales, "dvf_plus_2025_2", "dvf_plus_mutation", f"{root}/sales")
    write_copy_dump(
        trial.table("disposition"), "dvf_plus_2025_2", "dvf_plus_disposition", f"{root}/parts"
    )
    dump = CopyDump(spark, root, "*.txt")
    both = (dump.table(t).withColumn("table_name", F.lit(t)) for t in ("mutation", "disposition"))
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), both)
    return rows.select(*[F.array_join(c, ",").alias(c) if kind == "array<string>" else c for c, kind in rows.dtypes])


@query
def scan_source_tables(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    tables = {t: trial.table(t) for t in SOURCE_TABLES}
    widths = F.create_map(*[F.lit(v) for t, df in tables.items() for v in (t, len(df.columns))])
    counts = sinks.load_row_counts(tables).filter("table_name <> '(total)'")
    return counts.withColumn("n_columns", F.element_at(widths, F.col("table_name")))


@query
def gen_date_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the years with sales, and the number of sales on it."""
    sales = star(spark, folder).stg_mutations(("transaction_date", "transaction_year"))
    daily = sales.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("sales"))
    days = marts.date_spine_covering(sales)
    return days.join(daily, days.day == daily.transaction_date, "left").select(
        "day", F.coalesce("sales", F.lit(0)).alias("sales")
    )


# --- sinks ------------------------------------------------------------------------------------


@query
def write_csv_export(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_folder(spark, 'export')}/disposition_parcelle.csv"
    links = TrialTables(spark, folder).table("disposition_parcelle")
    sinks.write_csv_export(export.export_disposition_parcelle(links), path)
    return csv_files.scan_csv_table(spark, path, "disposition_parcelle")


@query
def write_partitioned_clustered(spark: SparkSession, folder: str) -> DataFrame:
    return fact(spark, folder).drop(sinks.YEAR_BUCKET)


def clustered_fact(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "clustered")
    clustered.write_clustered(fact(spark, folder).drop(sinks.YEAR_BUCKET), path)
    return path


@query
def write_clustered(spark: SparkSession, folder: str) -> DataFrame:
    return clustered.read_clustered(spark, clustered_fact(spark, folder)).drop(sinks.YEAR_BUCKET)


@query
def read_clustered(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"department_code": ["13", "75"], "property_type_label": ["UNE MAISON", "UN APPARTEMENT"]}
    rows = clustered.read_clustered(spark, clustered_fact(spark, folder), (2018, 2020), wanted)
    return rows.drop(sinks.YEAR_BUCKET)


@query
def delete_rows_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """The published fact without all departments but three, deleted in files that hold others."""
    path = clustered_fact(spark, folder)
    departments = export.check_departments(["13", "2A", "75"])
    clustered.delete_rows(spark, path, F.col("department_code").isin(departments))
    return clustered.read_clustered(spark, path).drop(sinks.YEAR_BUCKET)


@query
def write_truncate(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "truncate")
    parts = star(spark, folder).stg_dispositions()
    for _ in range(2):  # a repeat replaces, it does not add
        sinks.write_truncate(parts, path)
    return spark.read.parquet(path)


@query
def write_chunk(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "batches")
    sales = star(spark, folder).stg_mutations(("transaction_year", "transaction_price_eur"))
    early = F.col("transaction_year") < 2020
    sinks.write_chunk(sales.filter(early), path, "001")
    sinks.write_chunk(sales, path, "1")
    sinks.write_chunk(sales, path, "third")
    sinks.write_chunk(sales.filter("1 = 0"), path, "third")  # replaced by nothing
    sinks.write_chunk(sales.filter(~early), path, "1")
    return (
        sinks.read_chunks(spark, path)
        .groupBy(sinks.BATCH)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            serving.exact_sum("transaction_price_eur").alias("total_price_eur"),
        )
    )


@query
def materialize_layer(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "analytics")
    database = place.rsplit("/", 1)[-1].replace("-", "_")
    view = sinks.materialize_layer(
        spark, star(spark, folder).dim_property_types(), f"types_of_{database}", view=True
    )
    table = sinks.materialize_layer(
        spark, spark.table(view), "dim_property_types", database, location=place
    )
    return spark.table(table)


@query
def load_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return sinks.load_row_counts({t: trial.table(t) for t in SOURCE_TABLES})


@query
def list_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.list_partitions(fact(spark, folder))


# --- projections and filters ------------------------------------------------------------------


def _dumped_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Dumped sales with their point as hex geometry."""
    sales = TrialTables(spark, folder).mutation_dump()
    place = point_ewkb("point_x", "point_y", srid_of(F.col("coddep")))
    return sales.withColumn(MUTATION_POINT, place).drop("point_x", "point_y")


@query
def export_mutation(spark: SparkSession, folder: str) -> DataFrame:
    out = export.export_mutation(_dumped_sales(spark, folder))
    return _rounded(_rounded(out, "latitude", 6), "longitude", 6)


@query
def export_parcelle(spark: SparkSession, folder: str) -> DataFrame:
    return export.export_parcelle(TrialTables(spark, folder).table("parcelle"))


@query
def export_disposition_parcelle(spark: SparkSession, folder: str) -> DataFrame:
    return export.export_disposition_parcelle(
        TrialTables(spark, folder).table("disposition_parcelle")
    )


@query
def export_simple(spark: SparkSession, folder: str) -> DataFrame:
    return export.export_simple(TrialTables(spark, folder).table("local"), "local")


@query
def export_simple_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, filled and different values of every column of all tables that are exported as they are."""
    trial, parts = TrialTables(spark, folder), []
    for name in SIMPLE_EXPORT_TABLES:
        kept = export.export_simple(trial.table(name), name)
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in kept.columns]
        long = kept.select(F.lit(name).alias("table_name"), F.inline(F.array(*cells)))
        parts.append(
            long.groupBy("table_name", "column_name").agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count("value").alias("filled"),
                F.count_distinct("value").alias("different"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def array_first(spark: SparkSession, folder: str) -> DataFrame:
    sales = TrialTables(spark, folder).mutation_dump()
    return sales.select(
        "idmutation",
        scalars.array_first(F.col("l_codinsee")).alias("codinsee"),
        scalars.array_first(F.col("l_artcgi")).alias("artcgi"),
    )


@query
def point_to_latlon(spark: SparkSession, folder: str) -> DataFrame:
    sales = _dumped_sales(spark, folder).select("idmutation", "coddep", MUTATION_POINT)
    placed = export.point_to_latlon(sales)
    return _rounded(_rounded(placed, "latitude", 6), "longitude", 6)


@query
def filter_departments(spark: SparkSession, folder: str) -> DataFrame:
    parts = TrialTables(spark, folder).table("disposition")
    return export.filter_departments(parts, "disposition", ["2A", "04", "971"])


@query
def delete_outside_departments(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "stored")
    sinks.write_truncate(TrialTables(spark, folder).table("adresse"), path)
    export.delete_outside_departments(spark, path, "adresse", ["2B", "10", "974"])
    return spark.read.parquet(path)


@query
def stg_mutations(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_mutations()


@query
def stg_dispositions(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_dispositions()


@query
def stg_locals(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_locals()


@query
def stg_parcelles(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_parcelles()


@query
def stg_geo_departments(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_geo_departments()


@query
def stg_geo_communes(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_geo_communes()


@query
def price_positive(spark: SparkSession, folder: str) -> DataFrame:
    staged = star(spark, folder).staged("mutations", ("mutation_id", "transaction_price_eur"))
    return staging.price_positive(staged)


@query
def not_null_filter(spark: SparkSession, folder: str) -> DataFrame:
    links = star(spark, folder).stg_parcelles(("commune_code", "department_code"))
    return staging.not_null_filter(links, "commune_code").select("commune_code", "department_code")


@query
def dash_filters(spark: SparkSession, folder: str) -> DataFrame:
    return serving.dash_filters(
        fact(spark, folder), (2018, 2020), ["UNE MAISON", "UN APPARTEMENT"], ["13"]
    ).drop(sinks.YEAR_BUCKET)


# --- joins ------------------------------------------------------------------------------------


@query
def int_transactions_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        star(spark, folder).int_transactions_enriched(), "total_disposition_price_eur", 2
    )


@query
def fct_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).fct_transactions()


@query
def dim_communes(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).dim_communes()


@query
def fk_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return lookups.fk_anti_join(
        s.stg_dispositions(("mutation_id",)), "mutation_id",
        s.stg_mutations(("mutation_id",)), "mutation_id",
    )


@query
def resume_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries whose files a run that was cut short has not committed, and their rows."""
    landing = _deliver(spark, folder)
    root = new_folder(spark, "ingest")
    early = [p for p in _paths(spark, landing) if _year_of_path(p) < 2018]
    read = ingest.csv_reader("mutation")
    ingest.ingest_files(spark, early, f"{root}/raw", f"{root}/manifest", read)
    known = manifest.read_manifest(spark, f"{root}/manifest")
    waiting = manifest.resume_anti_join(ingest.discover(spark, landing, "*.csv"), known)
    rows = csv_files.scan_csv_table(spark, landing, "mutation", lineage=True)
    return (
        rows.join(waiting, ingest.SOURCE, "left_semi")
        .groupBy("anneemut")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query
def label_lookup(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return lookups.label_lookup(
        trial.table("mutation", ("idmutation", "idnatmut")),
        trial.table("ann_nature_mutation"),
        "idnatmut", "libnatmut", "nature_label",
    ).select("idmutation", "idnatmut", "nature_label")


@query
def label_lookup_local(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return lookups.label_lookup(
        trial.table("local", ("iddispoloc", "codtyploc")),
        trial.table("ann_type_local"),
        "codtyploc", "libtyploc", "type_label",
    ).select("iddispoloc", "codtyploc", "type_label")


@query
def address_join_parcel(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return lookups.address_join(
        trial.table("disposition_parcelle", ("iddispopar",)),
        trial.table("adresse_dispoparc"),
        trial.table("adresse"),
        "iddispopar",
    ).select("iddispopar", "idadr", "codvoie", "typvoie", "novoie", "codepostal")


@query
def address_join(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return lookups.address_join(
        trial.table("local", ("iddispoloc",)),
        trial.table("adresse_local"),
        trial.table("adresse"),
        "iddispoloc",
    ).select("iddispoloc", "idadr", "codvoie", "typvoie", "novoie", "codepostal")


# --- aggregations -----------------------------------------------------------------------------


@query
def disposition_agg(spark: SparkSession, folder: str) -> DataFrame:
    parts = star(spark, folder).stg_dispositions(("mutation_id", "disposition_price_eur"))
    return _rounded(enrich.disposition_agg(parts), "total_disposition_price_eur", 2)


@query
def local_agg(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.local_agg(
        star(spark, folder).stg_locals(("mutation_id", "main_room_count", "built_area_sqm"))
    )


def _parcels(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_parcelles(
        ("mutation_id", "disposition_parcel_id", "commune_code", "built_land_area_sqm",
         "agricultural_land_area_sqm", "natural_land_area_sqm")
    )


@query
def parcelle_agg(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.parcelle_agg(_parcels(spark, folder))


@query
def arg_first(spark: SparkSession, folder: str) -> DataFrame:
    return _parcels(spark, folder).groupBy("mutation_id").agg(
        enrich.arg_first("commune_code", "disposition_parcel_id").alias("commune_code")
    )


def _votes(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return marts.all_commune_codes(
        s.stg_parcelles(("commune_code", "department_code")),
        s.stg_mutations(("insee_code", "department_code")),
    )


@query
def mode_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return marts.mode_by_group(_votes(spark, folder), "commune_code", "department_code")


@query
def dim_property_types(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).dim_property_types()


@query
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return marts.distinct_pairs(star(spark, folder).stg_mutations(("insee_code", "department_code")))


@query
def tile_count_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.count_by_type(fact(spark, folder))


@query
def tile_value_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.value_by_type(fact(spark, folder))


@query
def tile_avg_price_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return serving.avg_price_by_year(fact(spark, folder))


@query
def tile_volume_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return serving.volume_by_year(fact(spark, folder))


@query
def tile_ppsqm_by_department(spark: SparkSession, folder: str) -> DataFrame:
    return serving.ppsqm_by_department(fact(spark, folder))


@query
def validate_rounded_avg(spark: SparkSession, folder: str) -> DataFrame:
    return serving.rounded_avg_by_year(fact(spark, folder))


@query
def raw_count_by_department(spark: SparkSession, folder: str) -> DataFrame:
    raw = TrialTables(spark, folder).table("mutation", ("anneemut", "coddep"))
    return serving.raw_count_by_department(raw, 2023)


@query
def year_department_stats(spark: SparkSession, folder: str) -> DataFrame:
    return serving.year_department_stats(fact(spark, folder), 2023)


@query
def trend_for_segment(spark: SparkSession, folder: str) -> DataFrame:
    return serving.trend_for_segment(fact(spark, folder), 2020, 2023, "13", "21")


@query
def median_price_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return serving.median_price_by_year(fact(spark, folder))


@query
def median_ppsqm_by_department(spark: SparkSession, folder: str) -> DataFrame:
    return serving.median_ppsqm_by_department(fact(spark, folder))


def _stored_sketch(spark: SparkSession, folder: str, value: str) -> DataFrame:
    """Counts per year and department of the published fact, written and read back."""
    path = f"{new_folder(spark, 'sketch')}/{value}"
    sketches.write_sketch(fact(spark, folder), [serving.YEAR, serving.DEPARTMENT], value, path)
    return spark.read.parquet(path)


@query
def sketch_median_price_by_year(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_sketch(spark, folder, serving.PRICE)
    return _rounded(sketches.median(stored, [serving.YEAR], "median_price_eur"), "median_price_eur", 4)


@query
def sketch_median_ppsqm_by_department(spark: SparkSession, folder: str) -> DataFrame:
    """Medians of a range of years, merged from what is stored for each year."""
    stored = _stored_sketch(spark, folder, serving.PPSQM).filter(F.col(serving.YEAR).between(2019, 2022))
    out = sketches.median(stored, [serving.DEPARTMENT], "median_price_per_sqm")
    return _rounded(out, "median_price_per_sqm", 4)


@query
def ppsqm_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return serving.ppsqm_distribution(fact(spark, folder))


@query
def volume_by_commune(spark: SparkSession, folder: str) -> DataFrame:
    places = _written(spark, folder, "geography", ("dim_geography",))["dim_geography"]
    out = serving.volume_by_commune(fact(spark, folder), places)
    return _rounded(_rounded(out, "centroid_lat", 6), "centroid_lon", 6)


@query
def accumulate_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after one delivery was emptied, one changed and one loaded twice."""
    _, _, log = _corrected(spark, folder)
    totals = manifest.accumulate_row_counts(manifest.read_manifest(spark, log))
    return totals.select("table_name", "row_count")


# --- sorts and top-k --------------------------------------------------------------------------


@query
def top_types(spark: SparkSession, folder: str) -> DataFrame:
    return serving.top_types(fact(spark, folder), 10)


@query
def order_by_year(spark: SparkSession, folder: str) -> DataFrame:
    counted = fact(spark, folder).groupBy("transaction_year").agg(
        F.count(F.lit(1)).alias("transaction_count")
    )
    return counted.orderBy("transaction_year")


@query
def order_by_metric(spark: SparkSession, folder: str) -> DataFrame:
    total = serving.exact_sum("transaction_price_eur").alias("total_price_eur")
    return (
        fact(spark, folder)
        .groupBy("department_code")
        .agg(total)
        .orderBy(F.desc("total_price_eur"), "department_code")
    )


# --- set operations ---------------------------------------------------------------------------


@query
def all_commune_codes(spark: SparkSession, folder: str) -> DataFrame:
    return _votes(spark, folder)


@query
def dim_geography(spark: SparkSession, folder: str) -> DataFrame:
    out = star(spark, folder).dim_geography()
    return _rounded(_rounded(out, "centroid_lat", 6), "centroid_lon", 6)


# --- scalar functions -------------------------------------------------------------------------


def _sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Typed sales before the price filter."""
    return star(spark, folder).staged("mutations", columns).select(*columns)


@query
def scalar_casts(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(
        spark, folder, "mutation_id", "transaction_year", "transaction_month",
        "transaction_price_eur", "land_area_sqm", "sold_parcel_count", "latitude",
        "department_code",
    )


@query
def normalize_bool(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder, "mutation_id", "is_vefa")


@query
def safe_parse_date(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder, "mutation_id", "transaction_date")


@query
def commune_code(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, folder).stg_parcelles(("disposition_parcel_id", "commune_code"))


@query
def department_from_commune(spark: SparkSession, folder: str) -> DataFrame:
    derived = scalars.department_from_commune(F.col("insee_code"))
    return _sales(spark, folder, "mutation_id", "insee_code").withColumn(
        "derived_department", derived
    )


@query
def level1_label(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("property_type_code")
    return _sales(spark, folder, "mutation_id", "property_type_code").select(
        "mutation_id",
        scalars.level1_code(code).alias("level1"),
        scalars.level1_label(code).alias("level1_label"),
    )


@query
def price_per_sqm(spark: SparkSession, folder: str) -> DataFrame:
    price, area = F.col("transaction_price_eur"), F.col("total_built_area_sqm")
    return _sales(
        spark, folder, "mutation_id", "transaction_price_eur", "total_built_area_sqm"
    ).select("mutation_id", scalars.price_per_sqm(price, area).alias("price_per_sqm"))


@query
def dim_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar of the years that the sales cover."""
    sales = star(spark, folder).stg_mutations(("transaction_year",))
    return marts.dim_dates(marts.date_spine_covering(sales))


@query
def calendar_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar attributes of every dated sale."""
    day = F.col("transaction_date")
    sales = star(spark, folder).stg_mutations(("mutation_id", "transaction_date"))
    return sales.filter(day.isNotNull()).select(
        "mutation_id", day.alias("date_key"), day.alias("full_date"),
        *scalars.calendar_columns(day),
    )


def _shapes(spark: SparkSession, folder: str) -> DataFrame:
    shapes = TrialTables(spark, folder).table("geo_communes", ("code", "nom", "geometry"))
    return shapes.withColumn("code", F.coalesce("code", F.concat(F.lit("?"), "nom")))


@query
def geojson_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _shapes(spark, folder).select(
        "code", geo.geojson_parse(F.col("geometry")).isNotNull().alias("is_valid")
    )


@query
def polygon_centroid(spark: SparkSession, folder: str) -> DataFrame:
    centre = geo.polygon_centroid(F.col("geometry"))
    return _shapes(spark, folder).select(
        "code", F.round(centre["lon"], 6).alias("lon"), F.round(centre["lat"], 6).alias("lat")
    )


@query
def spherical_centroid(spark: SparkSession, folder: str) -> DataFrame:
    centre = geo.spherical_centroid(F.col("geometry"))
    return _shapes(spark, folder).select("code", centre.alias("c")).select(
        "code", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat")
    )


# --- incremental ingestion --------------------------------------------------------------------


# Names of deliveries: a word of a set-up role, an accent and a blank must not change what is loaded.
_DELIVERY = {2014: "initial 2014", 2015: "sales_definitive_2015", 2016: "vente \u00e9 2016"}


def _deliver(spark: SparkSession, folder: str) -> str:
    """Sales delivered as CSV files, one folder per year."""
    root = new_folder(spark, "delivery")
    sales = TrialTables(spark, folder).table("mutation")
    name = F.col("anneemut").cast("string")
    for year, text in _DELIVERY.items():
        name = F.when(F.col("anneemut") == year, text).otherwise(name)
    (
        sales.withColumn("delivery", name)
        .write.partitionBy("delivery")
        .options(**sinks.CSV_WRITE_OPTIONS)
        .csv(root)
    )
    return root


def _paths(spark: SparkSession, landing: str) -> list[str]:
    """Paths of the delivered files, as many as the listing has."""
    found = ingest.discover(spark, landing, "*.csv").select("path")
    return sorted(r.path for r in found.toLocalIterator())


def _year_of_path(path: str) -> int:
    return int(path.rsplit("/", 2)[-2][-4:])


def _ingested(spark: SparkSession, target: str, log: str) -> DataFrame:
    return ingest.read_ingested(spark, target, "mutation", log).drop(ingest.SOURCE)


def _run_cycle(spark: SparkSession, folder: str) -> tuple[str, str, str]:
    """Ingest five files by hand, then the rest in groups of four."""
    landing = _deliver(spark, folder)
    root = new_folder(spark, "ingest")
    target, log = f"{root}/raw", f"{root}/manifest"
    read = ingest.csv_reader("mutation")
    ingest.ingest_files(spark, _paths(spark, landing)[:5], target, log, read)
    ingest.chunk_cycle(spark, landing, target, log, read, group=4)
    return landing, target, log


def _keep_header(spark: SparkSession, path: str) -> None:
    """Replace a CSV file by its header, through the file system that holds it."""
    header = spark.read.text(path).first()[0]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray((header + "\n").encode()))
    out.close()


def _corrected(spark: SparkSession, folder: str) -> tuple[str, str, str]:
    """The cycle, then all files of 2014 emptied and those of 2014 to 2016 loaded again."""
    landing, target, log = _run_cycle(spark, folder)
    paths = _paths(spark, landing)
    for path in paths:
        if _year_of_path(path) == 2014:
            _keep_header(spark, path)
    again = [p for p in paths if _year_of_path(p) <= 2016]
    ingest.reingest_subset(spark, again, target, log, ingest.csv_reader("mutation"))
    return landing, target, log


@query
def manifest_read_write(spark: SparkSession, folder: str) -> DataFrame:
    _, _, log = _run_cycle(spark, folder)
    totals = manifest.accumulate_row_counts(manifest.read_manifest(spark, log))
    return totals.select("table_name", "row_count")


@query
def chunk_cycle(spark: SparkSession, folder: str) -> DataFrame:
    _, target, log = _run_cycle(spark, folder)
    return _ingested(spark, target, log)


@query
def reingest_subset(spark: SparkSession, folder: str) -> DataFrame:
    _, target, log = _corrected(spark, folder)
    return _ingested(spark, target, log)


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    landing = _deliver(spark, folder)
    root = new_folder(spark, "stream")
    target, log = f"{root}/raw", f"{root}/manifest"
    ingest.stream_ingest(
        spark, landing, "mutation", raw_schema("mutation"), target, log, f"{root}/checkpoint", 5,
        lambda df: df.withColumn("anneemut", F.col("anneemut").cast("long")),
    )
    return _ingested(spark, target, log)


# Fields of one dump file, about 150 MB of shuffled rows: one task writes a file.
_DUMP_FIELDS = 20_000_000


def _dump_files(trial: TrialTables, name: str, key: str, fields: int = _DUMP_FIELDS) -> int:
    """Files to deliver a table in: at least three, and more as it grows, so that a file never does."""
    rows = trial.table(name, (key,)).count()
    return max(3, -(-rows * len(raw_columns(name)) // fields))


@query
def stream_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """Dump files of two tables, each file with a block of its own, as a stream with both as sinks."""
    root = new_folder(spark, "stream-dumps")
    landing, target, log = f"{root}/in", f"{root}/raw", f"{root}/manifest"
    names = {"mutation": "idmutation", "disposition": "iddispo"}
    trial = TrialTables(spark, folder)
    for name, key in names.items():
        rows = trial.table(name).repartition(_dump_files(trial, name, key))
        write_copy_dump(rows, "dvf_plus_2025_2", f"dvf_plus_{name}", f"{landing}/{name}")
    ingest.stream_cycle(spark, landing, target, log, f"{root}/checkpoint", ingest.dump_reader, "*.txt", 4)
    both = (ingest.read_ingested(spark, target, t, log).drop(ingest.SOURCE).withColumn("table_name", F.lit(t)) for t in names)
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), both)


@query
def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A release of the years to 2023, overlaid by a newer release of the years from 2022."""
    columns = ("mutation_id", "transaction_year", "transaction_price_eur", "department_code")
    sales = star(spark, folder).stg_mutations(columns)
    old = (
        sales.filter("transaction_year < 2024")
        .withColumn("transaction_price_eur", F.col("transaction_price_eur") + 1000.0)
        .withColumn("release", F.lit(1))
    )
    new = sales.filter("transaction_year >= 2022").withColumn("release", F.lit(2))
    path = new_folder(spark, "history")
    lookups.merge_release(spark, path, old, "mutation_id", "release", "transaction_year")
    lookups.merge_release(spark, path, new, "mutation_id", "release", "transaction_year")
    return read_release(spark, path, "transaction_year").select(
        "mutation_id", "release", "transaction_price_eur", "department_code"
    )


# --- data quality -----------------------------------------------------------------------------


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Sales named by more than one disposition."""
    return quality.dq_unique(star(spark, folder).stg_dispositions(("mutation_id",)), "mutation_id")


@query
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("transaction_date", "insee_code", "property_type_code", "mutation_id")
    return quality.dq_not_null(star(spark, folder).stg_mutations(columns), columns)


@query
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return quality.dq_relationships(
        s.stg_parcelles(("mutation_id",)), "mutation_id",
        s.stg_mutations(("mutation_id",)), "mutation_id",
    )


@query
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    sales = star(spark, folder).stg_mutations(("property_type_code",))
    classes = sales.select(scalars.level1_code(F.col("property_type_code")).alias("level1"))
    return quality.dq_accepted_values(classes, "level1", ("1", "2"))


@query
def dq_expression(spark: SparkSession, folder: str) -> DataFrame:
    sales = star(spark, folder).staged("mutations", ("transaction_price_eur",))
    return quality.dq_expression(sales, "transaction_price_eur", "> 0")


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dq_report(all_models(spark, folder))


@query
def dq_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dq_date_range(
        star(spark, folder).stg_mutations(("transaction_date",)), "transaction_date"
    )


@query
def dq_year_range(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dq_year_range(
        star(spark, folder).stg_mutations(("transaction_year",)), "transaction_year"
    )


@query
def dq_fk_chain(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return quality.dq_fk_chain(
        s.stg_parcelles(("disposition_id", "disposition_parcel_id")),
        s.stg_dispositions(("disposition_id",)),
        s.stg_locals(("disposition_parcel_id",)),
    )


@query
def dq_department_codes(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dq_department_codes(star(spark, folder).stg_mutations(("department_code",)))


@query
def dq_type_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dq_type_not_null(star(spark, folder).stg_mutations(("property_type_code",)))


@query
def dq_geometry_null_rate(spark: SparkSession, folder: str) -> DataFrame:
    sales = star(spark, folder).stg_mutations(("department_code", "latitude"))
    return quality.dq_geometry_null_rate(sales, "latitude", "department_code")


@query
def dq_department_coverage(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return quality.dq_coverage(
        s.stg_mutations(("department_code",)), "department_code",
        s.stg_geo_departments(("department_code",)), "department_code",
    )


@query
def dq_commune_coverage(spark: SparkSession, folder: str) -> DataFrame:
    s = star(spark, folder)
    return quality.dq_coverage(
        s.stg_parcelles(("commune_code",)), "commune_code",
        s.stg_geo_communes(("commune_code",)), "commune_code",
    )


@query
def dq_min_features(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return quality.dq_min_features(
        {t: trial.table(t, ("code",)) for t in ("geo_departments", "geo_communes")}
    )


@query
def dq_expected_tables(spark: SparkSession, folder: str) -> DataFrame:
    trial = TrialTables(spark, folder)
    return quality.dq_expected_tables(
        {t: trial.table(t) for t in (*PRINCIPAL_TABLES, *REFERENCE_TABLES)}
    )

