from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.operators import quality
from salesmart.operators.quality import Check


def test_declared_tests_are_complete():
    checks = quality.declared_checks()
    assert Counter(c.test for c in checks) == {
        "unique": 13, "not_null": 40, "relationships": 7, "accepted_values": 2, "expression": 1,
    }
    warn = [c for c in checks if c.severity == "warn"]
    assert Counter(c.test for c in warn) == {"relationships": 5, "accepted_values": 1}


@pytest.fixture
def models(spark):
    return {
        "child": spark.createDataFrame(
            [(1, "a", 5.0), (2, "b", -1.0), (2, None, None), (None, "z", 0.0), (9, "z", 2.0)],
            "k long, level string, price double"),
        "parent": spark.createDataFrame([(1,), (2,), (None,)], "k long"),
    }


def test_report_counts_planted_failures(models):
    checks = [
        Check("child", "k", "unique"), Check("child", "k", "not_null"),
        Check("child", "level", "not_null", "warn"),
        Check("child", "k", "relationships", "warn", "parent", "k"),
        Check("child", "level", "accepted_values", values=("a", "b")),
        Check("child", "price", "expression", values=("> 0",)),
        Check("parent", "k", "unique"),
    ]
    got = {(r.model, r["column"], r.test): (r.failures, r.status) for r in quality.dq_report(models, checks).collect()}
    assert got == {
        ("child", "k", "unique"): (1, "fail"), ("child", "k", "not_null"): (1, "fail"),
        ("child", "level", "not_null"): (1, "warn"), ("child", "k", "relationships"): (1, "warn"),
        ("child", "level", "accepted_values"): (1, "fail"),
        ("child", "price", "expression"): (2, "fail"), ("parent", "k", "unique"): (0, "pass"),
    }


def test_errors_stop_and_warnings_do_not(models):
    warn = quality.dq_report(models, [Check("child", "k", "relationships", "warn", "parent", "k")])
    quality.stop_on_error(warn)
    with pytest.raises(quality.QualityError, match="unique child.k"):
        quality.stop_on_error(quality.dq_report(models, [Check("child", "k", "unique")]))


def test_orphans_count_rows_of_a_key_once(spark):
    child = spark.createDataFrame([(7,)] * 500 + [(1,)] * 3 + [(None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert [tuple(r) for r in quality.dq_relationships(child, "k", parent, "k").collect()] == [(7, 500)]


def test_expected_tables(spark):
    full = spark.createDataFrame([(1,)], "v long")
    tables = {t: full for t in ("disposition", "disposition_parcelle", "parcelle", "adresse", "ann_cgi")}
    tables["mutation"] = full.filter("v > 1")
    got = {r.table_name: r.status for r in quality.dq_expected_tables(tables).collect()}
    assert got["mutation"] == "fail" and got["local"] == "fail"
    assert got["disposition"] == "pass" and got["ann_cgi"] == "pass" and got["ann_type_local"] == "warn"


def test_minimum_features_and_code_length(spark):
    codes = spark.createDataFrame([("01001",), ("970001",), (None,)], "commune_code string")
    got = quality.dq_min_features({"a": codes}, {"a": 4}).first()
    assert (got.features, got.minimum, got.ok) == (3, 4, False)
    assert [tuple(r) for r in quality.dq_code_length(codes).collect()] == [("970001", 1)]


def test_report_scans_a_model_twice_at_most(spark, sf):
    from salesmart.plans import catalog

    models = catalog.all_models(spark, sf)
    plan = quality.dq_report(models)._jdf.queryExecution().executedPlan().toString()
    scans = Counter(part.split("]", 1)[0] for part in plan.split("Location: InMemoryFileIndex(1 paths)[")[1:])
    assert len(scans) == len(quality.UNIQUE) and max(scans.values()) <= 2
    assert plan.count("Exchange hashpartitioning(domain") <= 2


def test_missing_departments(spark):
    from salesmart.functions.scalars import DEPARTMENTS

    codes = spark.createDataFrame([(c,) for c in DEPARTMENTS if c not in ("2A", "971")] + [("00",), (None,)], "department_code string")
    assert sorted(r[0] for r in quality.dq_missing_departments(codes).collect()) == ["2A", "971"]
    assert {r.value for r in quality.dq_department_codes(codes).collect()} == {"00", None}


def test_whole_number_keys_are_compared_as_numbers(spark):
    child = spark.createDataFrame(
        [(1, "1", "2020-01-01"), (1, "x", "2020-01-02"), (7, "7", None), (None, None, "2021-01-01")],
        "k int, t string, d string").withColumn("d", F.col("d").cast("date"))
    parent = spark.createDataFrame(
        [(1, "2020-01-01"), (2, "2020-01-01"), (7, None)], "k long, d string").withColumn("d", F.col("d").cast("date"))
    checks = [
        Check("child", "k", "unique"), Check("child", "k", "relationships", "warn", "parent", "k"),
        Check("child", "d", "relationships", "warn", "parent", "d"), Check("parent", "k", "unique"),
        Check("parent", "d", "unique"), Check("child", "k", "relationships", "warn", "child", "t"),
    ]
    report = quality.dq_report({"child": child, "parent": parent}, checks)
    assert [r.failures for r in report.collect()] == [1, 0, 2, 0, 1, 0]
    numbers = quality.dq_report({"child": child, "parent": parent}, checks[:2])
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "as string" not in plan and "Exchange hashpartitioning(domain" in plan
