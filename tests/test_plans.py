"""Physical plans: pruning, exchanges, no Python in the models."""

import re

import pytest

from salesmart.operators import enrich, serving
from salesmart.plans import catalog
from salesmart.plans.starschema import CHILD_COLUMNS, CatalogSource, FolderSource, StarSchema
from salesmart.sinks import tables as sinks


def plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    return root, catalog.star(spark, sf).publish(root)


def test_models_run_without_python(spark, sf):
    s = catalog.star(spark, sf)
    for name in ("stg_mutations", "int_transactions_enriched", "fct_transactions", "dim_communes", "dim_geography"):
        assert "Python" not in plan(s.model(name))


def test_enriched_sale_needs_one_exchange_per_input(spark, written, no_broadcast):
    models = written[1]
    joined = enrich.enriched(
        models["stg_mutations"], *[models[f"stg_{m}"].select(*c) for m, c in CHILD_COLUMNS.items()])
    text = plan(joined)
    assert text.count("Exchange hashpartitioning(mutation_id") == 4
    assert text.count("Exchange") == 4 and text.count("SortMergeJoin") == 3


def test_unused_children_are_not_read(spark, sf):
    by_year = serving.volume_by_year(catalog.star(spark, sf).fct_transactions())
    assert "lineitem" not in plan(by_year)
    assert "count(distinct" not in plan(catalog.star(spark, sf).fct_transactions())


def test_tile_reads_two_columns_of_the_fact(written):
    text = plan(serving.count_by_type(written[1]["fct_transactions"]))
    assert re.search(r"ReadSchema: struct<property_type_label:string>", text)


def test_segment_prunes_partitions_and_pushes_filters(written):
    text = plan(serving.trend_for_segment(written[1]["fct_transactions"], 2020, 2023, "13", "21"))
    assert re.search(r"PartitionFilters: \[[^]]*year_bucket[^]]*>= 2020", text)
    assert "EqualTo(department_code,13)" in text and "EqualTo(property_type_code,21)" in text


def test_fact_is_sorted_inside_its_files(spark, written):
    import pyarrow.parquet as pq

    for path in written[1]["fct_transactions"].inputFiles():
        t = pq.ParquetFile(path.removeprefix("file://")).read(["department_code", "property_type_code"]).to_pylist()
        keys = [(r["department_code"], r["property_type_code"] is not None, r["property_type_code"] or "") for r in t]
        assert keys == sorted(keys)


def test_bucketed_children_join_without_exchange(spark, written, no_broadcast):
    models = written[1]
    names = {}
    for model in ("stg_mutations", "stg_dispositions", "stg_locals", "stg_parcelles"):
        names[model] = f"bucketed_{model}"
        sinks.write_bucketed(models[model], names[model], "mutation_id", 4)
    joined = enrich.enriched(*[spark.table(n) for n in names.values()])
    assert "Exchange" not in plan(joined)
    assert joined.count() == models["stg_mutations"].count()


def test_stored_sources(spark, sf, tmp_path):
    raw = catalog.TrialTables(spark, sf)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_sales")
    for name in ("mutation", "disposition", "local", "disposition_parcelle", "geo_departments"):
        raw.table(name).write.parquet(str(tmp_path / name))
        raw.table(name).write.mode("overwrite").saveAsTable(f"raw_sales.{name}")
    want = sorted(map(str, catalog.star(spark, sf).fct_transactions().collect()))
    for source in (FolderSource(spark, str(tmp_path)), CatalogSource(spark, "raw_sales")):
        assert sorted(map(str, StarSchema(spark, source).fct_transactions().collect())) == want


def test_lookups_are_broadcast_by_size_only(spark, sf, no_broadcast):
    # above the threshold every lookup still has a plan: no hint forces a broadcast
    assert "Broadcast" not in plan(catalog.star(spark, sf).fct_transactions())


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_a_large_lookup_is_split(spark):
    from pyspark.sql import functions as F

    from salesmart.operators import lookups

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # two thirds of the rows share one key
        rows = spark.range(0, 60000, 1, 8).select(
            "id", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).cast("string").alias("code"))
        labels = spark.range(60000).select(F.col("id").cast("string").alias("code"), F.lit("x").alias("lib"))
        joined = lookups.label_lookup(rows, labels, "code", "lib", "label")
        text = _final_plan(joined)
        assert "SortMergeJoin(skew=true)" in text
        assert joined.count() == 60000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_year_and_department_is_written_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    try:
        sales = spark.range(0, 80000, 1, 8).select(
            F.col("id").alias("mutation_id"), F.when(F.col("id") % 3 < 2, 2023).otherwise(2014 + F.col("id") % 12)
            .cast("long").alias("transaction_year"), F.lit("75").alias("department_code"),
            F.lit("111").alias("property_type_code"), F.rand(1).alias("v"))
        path = str(tmp_path / "hot")
        assert sinks.write_partitioned_clustered(sales, path) == 80000
        files = spark.read.parquet(path).inputFiles()
        assert sum("year_bucket=2023" in f for f in files) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_median_counts_its_values_once(spark, sf):
    text = _final_plan(serving.median_price_by_year(catalog.fact(spark, sf)))
    text = text[: text.index("Initial Plan")]
    assert text.count("Scan parquet") == 1 and "ReusedExchange" in text
    text = _final_plan(serving.median_ppsqm_by_department(catalog.fact(spark, sf)))
    assert text[: text.index("Initial Plan")].count("Scan parquet") == 1
