"""Medians from stored band counts stay within their bound, for any merge and any order of rows."""

import math
import random
import statistics

import pytest

from salesmart.operators import sketches

SCHEMA = "year int, department string, price double"


def _sales(seed, n):
    rng = random.Random(seed)
    return [(2018 + rng.randrange(4), rng.choice(["13", "2A", None]), round(rng.lognormvariate(12, 1.5), 2)) for _ in range(n)]


def _medians(df, keys):
    return {tuple(r[k] for k in keys): (r.m, r.n) for r in sketches.median(df, keys, "m").collect()}


def _truth(rows, keys):
    at = {"year": 0, "department": 1}
    groups = {}
    for r in rows:
        if r[2] is not None and not math.isnan(r[2]):
            groups.setdefault(tuple(r[at[k]] for k in keys), []).append(r[2])
    return {k: (statistics.median(v), len(v)) for k, v in groups.items()}


def _within(got, want, bound):
    assert {k: n for k, (_, n) in got.items()} == {k: n for k, (_, n) in want.items()}
    return all(abs(got[k][0] - want[k][0]) <= bound * abs(want[k][0]) + 0.005 for k in want)


@pytest.mark.parametrize("digits", [2, 3, 5])
def test_estimates_are_within_the_bound_for_any_merge(spark, tmp_path, digits):
    rows = _sales(1, 4001)
    # a third of all sales at one price
    rows += [(2020, "13", 150_000.0)] * 2000 + [(2021, "2A", None), (2021, "2A", float("nan"))]
    path = str(tmp_path / "sketch")
    sketches.write_sketch(spark.createDataFrame(rows, SCHEMA).repartition(5), ["year", "department"], "price", path, digits)
    stored = spark.read.parquet(path)
    bound = sketches.error_bound(digits)
    for keys in (["year", "department"], ["year"], ["department"], []):
        assert _within(_medians(stored, keys), _truth(rows, keys), bound)
    some = [r for r in rows if r[0] >= 2020]
    assert _within(_medians(stored.filter("year >= 2020"), ["department"]), _truth(some, ["department"]), bound)


def test_parts_merge_to_the_whole(spark):
    rows = _sales(2, 3000)
    whole = sketches.sketch(spark.createDataFrame(rows, SCHEMA), ["year"], "price")
    parts = [sketches.sketch(spark.createDataFrame(rows[k::3], SCHEMA), ["year"], "price") for k in range(3)]
    merged = sketches.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["year"])
    order = ["year", "band_start", "band_width", "n"]
    assert sorted(map(tuple, merged.select(*order).collect())) == sorted(map(tuple, whole.select(*order).collect()))


def test_size_does_not_follow_the_sales(spark):
    rows = spark.range(200_000).selectExpr("cast(100000 + id * 17 % 900000 as double) AS price")
    assert sketches.sketch(rows, [], "price").count() <= 900


def test_small_negative_and_no_amounts(spark):
    rows = [(1, "a", 0.0), (1, "a", 0.01), (1, "a", 9.99), (2, "a", -3.0), (2, "a", -3.0), (3, "a", -1234.56), (4, "a", None)]
    stored = sketches.sketch(spark.createDataFrame(rows, SCHEMA), ["year"], "price")
    got = _medians(stored, ["year"])
    assert got[(1,)] == (0.01, 3) and got[(2,)] == (-3.0, 2) and (4,) not in got
    assert abs(got[(3,)][0] + 1234.56) <= 1234.56 * sketches.error_bound()
    empty = sketches.sketch(spark.createDataFrame([], SCHEMA), [], "price")
    assert sketches.median(empty, [], "m").collect() == []
    with pytest.raises(Exception, match="(?i)overflow|range|infin|represent"):
        sketches.sketch(spark.createDataFrame([(1, "a", 1e300)], SCHEMA), [], "price").collect()
