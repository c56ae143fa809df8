"""Aggregates, fact and dimensions on hand-made rows."""

import datetime

from pyspark.sql import functions as F

from salesmart.operators import enrich, lookups, marts, serving

PARCELS = (
    "mutation_id long, disposition_parcel_id long, commune_code string, "
    "built_land_area_sqm double, agricultural_land_area_sqm double, natural_land_area_sqm double"
)


def test_first_commune_by_id_even_when_null(spark):
    parcels = spark.createDataFrame(
        [(1, 5, "01005", 1.0, None, 2.0), (1, 3, None, 1.0, None, 2.0), (2, 9, "01009", 1.0, 1.0, 1.0),
         (2, 8, "01008", 1.0, 1.0, 1.0)], PARCELS)
    got = {r.mutation_id: r for r in enrich.parcelle_agg(parcels).collect()}
    assert got[1].commune_code is None and got[1].commune_count_parcelle == 1
    assert got[2].commune_code == "01008" and got[2].commune_count_parcelle == 2
    assert got[1].total_built_land_area_sqm == 2.0 and got[1].total_agricultural_land_area_sqm is None


def test_child_aggregates(spark):
    parts = spark.createDataFrame([(1, 10.0), (1, None), (2, None)], "mutation_id long, disposition_price_eur double")
    got = {r.mutation_id: tuple(r)[1:] for r in enrich.disposition_agg(parts).collect()}
    assert got == {1: (2, 10.0), 2: (1, None)}
    units = spark.createDataFrame([(1, 3, 10.0), (1, 4, None), (2, None, None)],
                                  "mutation_id long, main_room_count long, built_area_sqm double")
    got = {r.mutation_id: tuple(r)[1:] for r in enrich.local_agg(units).collect()}
    assert got == {1: (4, 7, 10.0), 2: (None, None, None)}


def test_vote_weights_and_ties(spark):
    parcels = spark.createDataFrame(
        [("75001", "75"), ("75001", "75"), ("75001", "92"), (None, "75"), ("13001", "13"), ("13001", "84")],
        "commune_code string, department_code string")
    # a deed pair counts once however many sales name it
    sales = spark.createDataFrame(
        [("75001", "92")] * 5 + [("75001", "93")] + [(None, "01")], "insee_code string, department_code string")
    votes = marts.all_commune_codes(parcels, sales)
    assert votes.count() == 7
    got = {r.commune_code: r.department_code
           for r in marts.mode_by_group(votes, "commune_code", "department_code").collect()}
    assert got == {"75001": "75", "13001": "13"}


def test_commune_name_falls_back_to_code(spark):
    parcels = spark.createDataFrame([("01001", "01"), ("01002", "01")], "commune_code string, department_code string")
    sales = spark.createDataFrame([], "insee_code string, department_code string")
    names = spark.createDataFrame([("01001", "Ici")], "commune_code string, commune_name string")
    got = sorted(tuple(r) for r in marts.dim_communes(parcels, sales, names).collect())
    assert got == [("01001", "Ici", "01"), ("01002", "01002", "01")]


def test_two_labels_of_a_code_are_two_rows(spark):
    sales = spark.createDataFrame([("111", "A"), ("111", "B"), ("111", "A"), (None, "C")],
                                  "property_type_code string, property_type_label string")
    assert marts.dim_property_types(sales).count() == 2


def test_calendar_has_every_day(spark):
    days = marts.dim_dates(marts.date_spine(spark))
    row = days.agg(F.count("*").alias("n"), F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).first()
    assert tuple(row) == (4383, datetime.date(2014, 1, 1), datetime.date(2025, 12, 31))


def test_median_equals_sorting(spark):
    import random
    rng = random.Random(3)
    rows = [(g, v) for g in ("a", "b", "c") for v in [round(rng.lognormvariate(10, 2), 2) for _ in range(201 if g == "a" else 100)]]
    rows += [("a", 7.0)] * 150 + [("d", 1.0), ("d", None), ("e", None), ("f", -3.0), ("f", 0.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in serving.exact_median(df, "g", "v", "m").collect()}
    import statistics
    want = {}
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        if values:
            want[g] = round(statistics.median(values), 4)
    assert got == want


def test_merge_keeps_the_newest(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k long, release int, v string")
    new = spark.createDataFrame([(2, 2, None), (3, 2, "c")], "k long, release int, v string")
    got = sorted(tuple(r) for r in lookups.incremental_merge(old, new, "k", "release").collect())
    assert got == [(1, 1, "a"), (2, 2, None), (3, 2, "c")]
    got = sorted(tuple(r) for r in lookups.append_new(old, new, "k").collect())
    assert got == [(1, 1, "a"), (2, 1, "b"), (3, 2, "c")]


def test_distribution_last_band_is_open(spark):
    df = spark.createDataFrame([(0.0,), (499.9,), (500.0,), (1e9,), (None,)], "price_per_sqm double")
    got = [tuple(r) for r in serving.ppsqm_distribution(df).collect()]
    assert got == [(0.0, 2), (500.0, 1), (20000.0, 1)]


def test_disposition_totals_are_whole_cents(spark):
    from salesmart.operators import enrich

    rows = [(1, 0.1)] * 3 + [(1, None), (2, None)] + [(3, 1e15)] + [(3, 0.01)] * 7
    got = {}
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "mutation_id long, disposition_price_eur double")
        for r in enrich.disposition_agg(df.repartition(3)).collect():
            got.setdefault(r.mutation_id, []).append((r.disposition_count_actual, r.total_disposition_price_eur))
    assert got == {1: [(4, 0.3)] * 2, 2: [(1, None)] * 2, 3: [(8, 1000000000000000.07)] * 2}
