import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.functions import geo, projection
from salesmart.operators import export

SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}'
HOLE = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[2,0],[4,0],[4,4],[2,4],[2,0]]]}'
TRIANGLE = '{"coordinates":[[[0,0],[0,3],[3,0],[0,0]]],"type":"Polygon"}'
PAIR = '{"type":"MultiPolygon","coordinates":[[[[0,0],[2,0],[2,2],[0,2],[0,0]]],[[[10,0],[12,0],[12,2],[10,2],[10,0]]]]}'
BAD = [
    None, "", "nonsense", "{}", '{"type":"Polygon"}', '{"type":"Polygon","coordinates":[]}',
    '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,0]]]}',
    '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1]]]}',
    '{"type":"Polygon","coordinates":[[[0,0],[999,0],[1,1],[0,0]]]}',
    '{"type":"MultiPolygon","coordinates":[[]]}',
]


def test_centroids(spark):
    df = spark.createDataFrame([(t,) for t in (SQUARE, HOLE, TRIANGLE, PAIR)], "g string")
    got = [(r.c.lon, r.c.lat) for r in df.select(geo.polygon_centroid(F.col("g")).alias("c")).collect()]
    want = [(2, 2), (1, 2), (1, 1), (6, 1)]
    for a, b in zip(got, want):
        assert a == pytest.approx(b)


def _polygon(*rings):
    return json.dumps({"type": "Polygon", "coordinates": rings})


def _spherical(spark, shapes):
    df = spark.createDataFrame(list(enumerate(shapes)), "i int, g string")
    rows = df.select("i", geo.spherical_centroid(F.col("g")).alias("c")).orderBy("i").collect()
    return [r.c and (r.c.lon, r.c.lat) for r in rows]


def test_spherical_centroids_of_closed_form(spark):
    octant = [[0, 0], [90, 0], [0, 90], [0, 0]]
    cap = [[k * 10 - 180, 60] for k in range(36)] + [[-180, 60]]
    south = [[k * 30 - 180, -80] for k in range(12)] + [[-180, -80]]
    line = [[179, -1], [-179, -1], [-179, 1], [179, 1], [179, -1]]
    lune = [[10, 0], [10, 90], [50, 0], [10, 0]]
    got = _spherical(spark, [_polygon(octant), _polygon(octant[::-1]), _polygon(cap), _polygon(south), _polygon(line), _polygon(lune)])
    corner = math.degrees(math.asin(1 / math.sqrt(3)))
    assert got[0] == pytest.approx((45, corner)) and got[1] == pytest.approx((45, corner))
    assert got[2][1] == pytest.approx(90) and got[3][1] == pytest.approx(-90)
    assert abs(got[4][0]) == pytest.approx(180) and got[4][1] == pytest.approx(0, abs=1e-12)
    # a triangle of the pole and a stretch of the equator: integrals of x, y and z by hand
    wide = math.radians(40)
    flat, up = math.pi / 4 * 2 * math.sin(wide / 2), wide / 2
    assert got[5] == pytest.approx((30, math.degrees(math.atan2(up, flat))))


def test_spherical_centroid_against_many_points(spark):
    rng = np.random.default_rng(4)
    ring = [[0, 30], [40, 20], [60, 55], [25, 70], [0, 30]]
    hole = [[20, 35], [20, 45], [35, 45], [35, 35], [20, 35]]

    def unit(lon, lat):
        lon, lat = np.radians(lon), np.radians(lat)
        return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], -1)

    def inside(points, corners):  # convex, counterclockwise: left of every arc
        u = unit(*np.array(corners, float).T)
        area = sum(np.cross(a, b) for a, b in zip(u, u[1:]))
        turn = 1 if area @ u.sum(axis=0) > 0 else -1
        return np.all([turn * (points @ np.cross(a, b)) > 0 for a, b in zip(u, u[1:])], axis=0)

    points = rng.normal(size=(2_000_000, 3))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    kept = points[inside(points, ring) & ~inside(points, hole)].mean(axis=0)
    want = math.degrees(math.atan2(kept[1], kept[0])), math.degrees(math.atan2(kept[2], math.hypot(*kept[:2])))
    assert _spherical(spark, [_polygon(ring, hole)])[0] == pytest.approx(want, abs=0.15)


def test_spherical_and_planar_meet_for_small_shapes(spark):
    shapes = [
        _polygon([[lon, lat], [lon + w, lat], [lon + w, lat + w], [lon, lat + w], [lon, lat]])
        for lon, lat in ((2.3, 48.8), (-61.5, 16.2), (55.4, -21.1)) for w in (0.1, 0.001, 0.0001)
    ]
    df = spark.createDataFrame(list(enumerate(shapes)), "i int, g string")
    flat = [(r.c.lon, r.c.lat) for r in df.select("i", geo.polygon_centroid(F.col("g")).alias("c")).orderBy("i").collect()]
    for (a, b), (c, d), text in zip(_spherical(spark, shapes), flat, shapes):
        width = json.loads(text)["coordinates"][0][1][0] - json.loads(text)["coordinates"][0][0][0]
        # the top of a box is narrower than its foot: a shift that falls with the square of the width
        # the last bits of unit vectors are a millimetre for a box of eleven metres
        assert abs(a - c) < 1e-8 and abs(b - d) < 0.01 * width * width + 1e-8


def test_spherical_centroid_of_bad_and_flat_shapes(spark):
    flat = _polygon([[5, 5], [5, 5], [5, 5], [5, 5]])
    opposite = _polygon([[0, 0], [180, 0], [90, 45], [0, 0]])
    got = _spherical(spark, [*BAD, flat, opposite, PAIR])
    assert got[: len(BAD)] == [None] * len(BAD) and got[len(BAD)] is None
    assert got[-1] == pytest.approx((6, 1), abs=2e-2)


def test_bad_geometry_is_null_and_keeps_its_row(spark):
    df = spark.createDataFrame([(t,) for t in BAD], "g string")
    out = df.select(geo.geojson_parse(F.col("g")).alias("p"), geo.polygon_centroid(F.col("g")).alias("c")).collect()
    assert len(out) == len(BAD) and all(r.p is None and r.c is None for r in out)


def _to_utm(lat, lon, meridian, south):
    """Forward transverse Mercator, an independent check of the inverse."""
    f, a = projection.FLATTENING, projection.SEMI_MAJOR
    n = f / (2 - f)
    big = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = math.radians(lat), math.radians(lon - meridian)
    e = math.sqrt(f * (2 - f))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    x = eta + sum(c * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, c in enumerate(alpha, 1))
    y = xi + sum(c * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, c in enumerate(alpha, 1))
    return 500000 + 0.9996 * big * x, (10000000 if south else 0) + 0.9996 * big * y


def _to_grid(lat, lon):
    phi = math.radians(lat)
    r = projection.CONE_RADIUS * math.exp(-projection.CONE * projection._isometric(phi))
    angle = projection.CONE * math.radians(lon - 3.0)
    return 700000 + r * math.sin(angle), projection.APEX_Y - r * math.cos(angle)


def test_reprojection_round_trip(spark):
    places = [("75", 48.8566, 2.3522), ("2A", 41.9, 8.7), ("29", 48.4, -4.5), ("971", 16.2, -61.5),
              ("972", 14.6, -61.0), ("973", 4.9, -52.3), ("974", -21.1, 55.5), ("976", -12.8, 45.2)]
    rows = []
    for code, lat, lon in places:
        x, y = _to_utm(lat, lon, *projection.UTM_ZONES[code]) if code in projection.UTM_ZONES else _to_grid(lat, lon)
        rows.append((code, lat, lon, x, y))
    rows.append(("99X", 0.0, 0.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "d string, lat double, lon double, x double, y double")
    got = projection.with_latlon(df, "x", "y", "d").collect()
    for r in got[:-1]:
        assert r.latitude == pytest.approx(r.lat, abs=1e-8), r.d
        assert r.longitude == pytest.approx(r.lon, abs=1e-8), r.d
    assert got[-1].latitude is None and got[-1].longitude is None


def test_reference_system_of_the_value_decides(spark):
    grid, reunion, world = _to_grid(48.8566, 2.3522), _to_utm(-21.1, 55.5, 57.0, True), _to_utm(46.8, -56.2, -57.0, False)
    rows = [("a", 2.3522, 48.8566, 4326), ("b", *grid, 2154), ("c", *reunion, 2975), ("d", *world, 4467), ("e", *world, 32621),
            ("f", *reunion, 32740), ("g", 1.0, 1.0, 3857), ("h", *grid, 0), ("i", *grid, None), ("j", None, 1.0, 4326)]
    df = spark.createDataFrame([(k, x, y, s, "75") for k, x, y, s in rows], "k string, x double, y double, s int, d string")
    got = {r.k: (r.latitude, r.longitude) for r in projection.with_latlon(df, "x", "y", "d", "s").collect()}
    want = {"a": (48.8566, 2.3522), "b": (48.8566, 2.3522), "c": (-21.1, 55.5), "d": (46.8, -56.2), "e": (46.8, -56.2),
            "f": (-21.1, 55.5), "h": (48.8566, 2.3522), "i": (48.8566, 2.3522)}
    for k, place in want.items():
        assert got[k] == pytest.approx(place, abs=1e-5), k
    assert got["g"] == got["j"] == (None, None)


def test_grid_constants_match_published_values():
    # published constants of the national grid: cone exponent, radius constant, apex northing
    assert projection.CONE == pytest.approx(0.7256077650, abs=1e-9)
    assert projection.CONE_RADIUS == pytest.approx(11754255.426, abs=1e-2)
    assert projection.APEX_Y == pytest.approx(12655612.050, abs=1e-2)


def _point(x, y, order="<", srid=True):
    head = struct.pack(order + "BI", 1 if order == "<" else 0, 1 | (0x20000000 if srid else 0))
    return (head + (struct.pack(order + "I", 2154) if srid else b"") + struct.pack(order + "dd", x, y)).hex()


def _points(*xy):
    head = struct.pack("<BIII", 1, 4 | 0x20000000, 2154, len(xy))
    return (head + b"".join(struct.pack("<BIdd", 1, 1, *p) for p in xy)).hex().upper()


def test_binary_points(spark):
    rows = [(_point(1.5, 2.5),), (_point(3, 4, ">"),), (_point(5, 6, srid=False),), (None,),
            (_points((0, 0), (2, 4)),), (_points((1, 1), (2, 2), (6, 3)),), ("0103",), ("",), ("01zz00000020",), ("010",), (_point(1, 2)[:-1] + "x",)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, g string").repartition(3)
    got = {r.i: r.p and (r.p.x, r.p.y) for r in df.select("i", projection.ewkb_position("g").alias("p")).collect()}
    empty = (None, (None, None))
    assert got[0] == (1.5, 2.5) and got[1] == (3, 4) and got[2] == (5, 6)
    assert got[4] == (1, 2) and got[5] == (3, 2)
    assert all(got[i] in empty for i in (3, 6, 7, 8, 9, 10))


def test_export_of_sales(spark):
    rows = [("1", "75", ["75056", "75057"], [], _point(652381.0, 6862047.0), "poly", "x"),
            ("2", "13", None, ["A"], None, None, None)]
    df = spark.createDataFrame(rows, "idmutation string, coddep string, l_codinsee array<string>, "
                                     "l_section array<string>, geomlocmut string, geompar string, refdoc string")
    out = export.export_mutation(df)
    assert out.columns == ["idmutation", "coddep", "codinsee", "section", "latitude", "longitude"]
    a, b = sorted(out.collect())
    assert a.codinsee == "75056" and a.section is None
    assert a.latitude == pytest.approx(48.856, abs=2e-3) and a.longitude == pytest.approx(2.351, abs=2e-3)
    assert b.codinsee is None and b.section == "A" and b.latitude is None
    assert export.export_mutation(df, ["13"]).count() == 1


def test_department_filter(spark):
    df = spark.createDataFrame([("75",), ("13",), (None,)], "coddep string")
    assert export.filter_departments(df, "local", ["75"]).count() == 1
    assert export.filter_departments(df, "local", None).count() == 3
    assert export.filter_departments(df, "ann_cgi", ["75"]).count() == 3
    for code in ("01", "2A", "2B", "976"):
        export.check_departments([code])
    for code in ("1", "75A", "20A", "977", "75'; --", "", "75\n", "00", "20", "96", "99"):
        with pytest.raises(ValueError):
            export.check_departments([code])
