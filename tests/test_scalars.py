import datetime

import pytest
from pyspark.sql import functions as F

from salesmart.functions import scalars
from salesmart.operators import staging


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("r")).collect()]


def test_flags_other_than_true_are_false(spark):
    texts = ["t", "T", "true", "TRUE", "1", "f", "0", "yes", "", None]
    assert column(spark, texts, scalars.normalize_bool) == [True] * 5 + [False] * 5


def test_dates_that_cannot_be_read_are_null(spark):
    texts = ["2023-06-15", "2023-6-5", "2023", "2023-02-30", "15/06/2023", "not-a-date", None]
    assert column(spark, texts, scalars.safe_parse_date) == [
        datetime.date(2023, 6, 15), datetime.date(2023, 6, 5), None, None, None, None, None,
    ]


def test_strict_cast_raises_on_bad_text(spark):
    raw = spark.createDataFrame([("x", "1", None, None, None, None)],
                                "iddispo string, idmutation string, nodispo string, "
                                "valeurfonc string, nblot string, coddep string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage("dispositions", raw).collect()


def test_price_filter_drops_null_zero_negative_and_nan(spark):
    df = spark.createDataFrame(
        [(1.0,), (0.0,), (-5.0,), (None,), (float("nan"),)], "transaction_price_eur double"
    )
    assert [r[0] for r in staging.price_positive(df).collect()] == [1.0]


def test_price_per_area_guards_zero_and_null(spark):
    df = spark.createDataFrame([(100.0, 50.0), (100.0, 0.0), (100.0, None), (None, 5.0)], "p double, a double")
    got = [r[0] for r in df.select(scalars.price_per_sqm(F.col("p"), F.col("a"))).collect()]
    assert got == [2.0, None, None, None]


def test_commune_code_needs_both_parts(spark):
    df = spark.createDataFrame([("01", "004"), ("2A", "004"), ("971", "05"), ("01", None), (None, "004")],
                               "d string, c string")
    got = [r[0] for r in df.select(scalars.commune_code(F.col("d"), F.col("c"))).collect()]
    assert got == ["01004", "2A004", "97105", None, None]


def test_department_of_a_commune(spark):
    texts = ["75056", "97105", "2A004", "97", None]
    assert column(spark, texts, scalars.department_from_commune) == ["75", "971", "2A", "97", None]


def test_level1_label(spark):
    texts = ["111", "21", "3", ""]
    assert column(spark, texts, scalars.level1_label) == [
        "Built property", "Unbuilt land", "Other", "Other",
    ]


def test_array_text(spark):
    texts = ["{01004,2A004}", "{}", '{"a b","c,d"}', "{NULL,x}", None]
    assert column(spark, texts, scalars.pg_array) == [
        ["01004", "2A004"], [], ["a b", "c,d"], [None, "x"], None,
    ]
    firsts = column(spark, texts, lambda v: scalars.array_first(scalars.pg_array(v)))
    assert firsts == ["01004", None, "a b", None, None]


def test_quoted_array_text(spark):
    texts = [r'{"a,b\"c","d"}', r'{"NULL",null,"","\\"}', '{"' + "x" * 100_000 + '",y}', '{a,"line\nbreak"}']
    assert column(spark, texts, scalars.pg_array) == [
        ['a,b"c', "d"], ["NULL", None, "", "\\"], ["x" * 100_000, "y"], ["a", "line\nbreak"],
    ]


def test_long_array_text_in_linear_time(spark):
    many = 100_000
    texts = ["{" + ",".join(f'"{i}"' for i in range(many)) + "}", "{" + ",".join(map(str, range(many))) + "}"]
    assert column(spark, texts, lambda v: F.size(scalars.pg_array(v))) == [many, many]


def test_departments():
    import re

    assert len(scalars.DEPARTMENTS) == 101 and all(re.match(scalars.OFFICIAL_DEPARTMENT, c) for c in scalars.DEPARTMENTS)
    assert not any(re.match(scalars.OFFICIAL_DEPARTMENT, c) for c in ("00", "20", "96", "99", "975", "977", "2C"))


def test_calendar_starts_weeks_on_sunday(spark):
    df = spark.createDataFrame([(datetime.date(2023, 1, 1),), (datetime.date(2023, 1, 7),),
                                (datetime.date(2023, 12, 4),)], "d date")
    got = [tuple(r) for r in df.select(*scalars.calendar_columns(F.col("d"))).collect()]
    assert got == [
        (2023, 1, 1, "January", 1, True), (2023, 1, 1, "January", 7, True),
        (2023, 4, 12, "December", 2, False),
    ]
