"""Delivered files to marts, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from salesmart.sources.trial_points import point_ewkb, srid_of
from salesmart.operators.quality import QualityError
from salesmart.plans import catalog
from salesmart.plans.build import build_from_csv, build_from_dump, exported
from salesmart.sinks import tables as sinks
from salesmart.sources.contracts import PRINCIPAL_TABLES, REFERENCE_TABLES
from salesmart.sources.copy_dump import CopyDump, write_copy_dump


@pytest.fixture(scope="module")
def boundaries(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("geo")
    trial = catalog.TrialTables(spark, sf)
    for table, name in (("geo_departments", "departements-1000m.geojson"), ("geo_communes", "communes-1000m.geojson")):
        rows = trial.table(table).collect()
        # every department of the sales must be known, or the declared check stops the run
        features = [{"type": "Feature", "properties": {"code": r.code or "24", "nom": r.nom},
                     "geometry": json.loads(r.geometry) if r.geometry else None}
                    for r in rows if r.code or table == "geo_departments"]
        (folder / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    return str(folder)


def _comparable(df):
    return df.drop("year_bucket", "latitude", "longitude", "department_name", "commune_code")


def test_csv_delivery(spark, sf, boundaries, tmp_path):
    trial = catalog.TrialTables(spark, sf)
    for table in (*PRINCIPAL_TABLES, *REFERENCE_TABLES):
        sinks.write_csv_export(trial.table(table), str(tmp_path / "csv" / f"{table}.csv"))
    # at this scale one line key occurs twice, which the declared unique checks find
    with pytest.raises(QualityError, match="unique stg_dispositions.disposition_id"):
        build_from_csv(spark, str(tmp_path / "csv"), boundaries, str(tmp_path / "out"))
    fact = spark.read.parquet(str(tmp_path / "out" / "analytics" / "fct_transactions"))
    want = catalog.star(spark, sf).fct_transactions()
    drop = ("year_bucket", "department_name")
    assert sorted(map(str, fact.drop(*drop).collect())) == sorted(map(str, want.drop(*drop).collect()))
    assert fact.filter("department_name IS NULL").count() == 0
    report = spark.read.parquet(str(tmp_path / "out" / "analytics" / "dq_report"))
    assert report.count() == 63 + 8  # declared tests and documented rules


def test_dump_delivery(spark, sf, boundaries, tmp_path):
    trial = catalog.TrialTables(spark, sf)
    place = point_ewkb("point_x", "point_y", srid_of(F.col("coddep")))
    sales = trial.table("mutation_dump").withColumn("geomlocmut", place).drop("point_x", "point_y")
    lines = {t: trial.table(t).dropDuplicates([k]) for t, k in (
        ("disposition", "iddispo"), ("local", "iddispoloc"), ("disposition_parcelle", "iddispopar"))}
    # communes without a code fail a declared check, so this delivery has none
    lines["disposition_parcelle"] = lines["disposition_parcelle"].fillna("000", ["codcomm"])
    tables = {"mutation": sales, **lines, **{t: trial.table(t) for t in ("parcelle", "adresse", *REFERENCE_TABLES)}}
    for name, df in tables.items():
        schema = "dvf_plus_annexe" if name in REFERENCE_TABLES else "dvf_plus_2025_2"
        table = name if name in REFERENCE_TABLES else f"dvf_plus_{name}"
        write_copy_dump(df, schema, table, str(tmp_path / "dump" / name))
    models = build_from_dump(spark, str(tmp_path / "dump"), boundaries, str(tmp_path / "out"), pattern="*.txt")
    fact = models["fct_transactions"]
    want = catalog.star(spark, sf).fct_transactions()
    rooms = "room_count"
    assert sorted(map(str, _comparable(fact).drop(rooms).collect())) == sorted(
        map(str, _comparable(want).drop(rooms).collect()))
    assert fact.filter("latitude IS NULL").count() == 0
    statuses = {r.status for r in models["dq_report"].select("status").distinct().collect()}
    assert statuses == {"pass", "warn"}

    dump = CopyDump(spark, str(tmp_path / "dump"), "*.txt")
    some = exported({t: dump.table(t) for t in ("mutation", "local", "ann_cgi")}, ["13"])
    for table in ("mutation", "local"):
        assert some[table].count() == tables[table].filter("coddep = '13'").count() > 0
    assert some["ann_cgi"].count() == tables["ann_cgi"].count()


def test_incomplete_delivery_stops(spark, sf, boundaries, tmp_path):
    trial = catalog.TrialTables(spark, sf)
    for table in ("mutation", "disposition"):
        sinks.write_csv_export(trial.table(table), str(tmp_path / "csv" / f"{table}.csv"))
    with pytest.raises(QualityError, match="missing or empty: adresse, disposition_parcelle, local, parcelle"):
        build_from_csv(spark, str(tmp_path / "csv"), boundaries, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()  # nothing is replaced by a delivery that is not whole


def test_layers_have_their_namespaces(spark, sf, tmp_path):
    from salesmart.plans.starschema import LAYERS, MODELS, register_models

    root = str(tmp_path / "analytics")
    catalog.star(spark, sf).publish(root)
    for _ in range(2):
        names = register_models(spark, root, default="plain_space", namespaces={"marts": " own_space "})
    assert set(names) == set(MODELS)
    kinds = {t.name: (t.namespace[-1], t.tableType) for db in ("plain_space", "own_space") for t in spark.catalog.listTables(db)}
    assert all(kinds[m] == ("plain_space", "VIEW") for layer in LAYERS[:2] for m in layer)
    assert all(kinds[m] == ("own_space", "EXTERNAL") for m in LAYERS[2])
    fact = spark.table(names["fct_transactions"])
    assert fact.count() == spark.read.parquet(f"{root}/fct_transactions").count() > 0
    assert "PartitionFilters: [isnotnull(year_bucket" in fact.filter("year_bucket = 2020")._jdf.queryExecution().toString()


def test_calendar_bounds(spark, sf):
    from salesmart.plans.starschema import StarSchema
    from salesmart.sources.trial_tables import TrialTables

    trial = TrialTables(spark, sf)
    assert StarSchema(spark, trial, ("2020-01-01", "2021-01-01")).dim_dates().count() == 366
    years = StarSchema(spark, trial, None).dim_dates().select("year").distinct().count()
    assert years == catalog.star(spark, sf).stg_mutations(("transaction_year",)).distinct().count()
