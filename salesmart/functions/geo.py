"""Boundary geometry as native columns: GeoJSON parsing, ring checks, area-weighted centroid.

``polygon_centroid`` is planar, over longitude and latitude. ``spherical_centroid`` takes edges as arcs
of great circles, so it holds for shapes of any size within a hemisphere, over the date line and
around a pole. For shapes of the size of a commune the two are metres apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RINGS = "array<array<array<double>>>"


def geojson_polygons(text: Column) -> Column:
    """GeoJSON text -> array of polygons (rings of [lon, lat]); NULL unless a (multi)polygon."""
    parsed = F.from_json(text, "type string, coordinates string")
    kind, coordinates = parsed["type"], parsed["coordinates"]
    return F.when(kind == "Polygon", F.array(F.from_json(coordinates, _RINGS))).when(
        kind == "MultiPolygon", F.from_json(coordinates, f"array<{_RINGS}>")
    )


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def _good_point(point: Column) -> Column:
    lon, lat = F.get(point, F.lit(0)), F.get(point, F.lit(1))
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def _good_ring(ring: Column) -> Column:
    closed = F.coalesce(F.get(ring, F.lit(0)) == _last(ring), F.lit(False))
    return (F.size(ring) >= 4) & closed & F.forall(ring, _good_point)


def valid_polygons(polygons: Column) -> Column:
    """At least one polygon, each with rings that are closed, long enough and on the globe."""
    every = F.forall(
        polygons,
        lambda rings: F.coalesce((F.size(rings) >= 1) & F.forall(rings, _good_ring), F.lit(False)),
    )
    return F.coalesce((F.size(polygons) >= 1) & every, F.lit(False))


def geojson_parse(text: Column) -> Column:
    """The text itself when it is a valid (multi)polygon, else NULL; never an error."""
    return F.when(valid_polygons(geojson_polygons(text)), text)


def _ring_moments(ring: Column, sign: Column) -> Column:
    """Signed area and first moments of one ring, relative to its first point for precision."""
    origin = F.get(ring, F.lit(0))
    ox, oy = F.get(origin, F.lit(0)), F.get(origin, F.lit(1))

    def edge(a: Column, b: Column) -> Column:
        ax, ay = F.get(a, F.lit(0)) - ox, F.get(a, F.lit(1)) - oy
        bx, by = F.get(b, F.lit(0)) - ox, F.get(b, F.lit(1)) - oy
        cross = ax * by - bx * ay
        return F.struct(
            cross.alias("c"), ((ax + bx) * cross).alias("x"), ((ay + by) * cross).alias("y")
        )

    steps = F.size(ring) - 1
    edges = F.zip_with(F.slice(ring, F.lit(1), steps), F.slice(ring, F.lit(2), steps), edge)
    total = F.aggregate(edges, _zero("c", "x", "y"), lambda s, e: _plus(s, e, "c", "x", "y"))
    area = sign * F.abs(total["c"]) / 2
    return F.struct(
        area.alias("c"),
        F.coalesce(area * (ox + F.try_divide(total["x"], 3 * total["c"])), F.lit(0.0)).alias("x"),
        F.coalesce(area * (oy + F.try_divide(total["y"], 3 * total["c"])), F.lit(0.0)).alias("y"),
    )


def _zero(*names: str) -> Column:
    return F.struct(*[F.lit(0.0).alias(n) for n in names])


def _plus(a: Column, b: Column, *names: str) -> Column:
    return F.struct(*[(a[n] + b[n]).alias(n) for n in names])


def polygons_centroid(polygons: Column) -> Column:
    """struct<lon, lat> of valid polygons; holes weigh negatively; NULL for flat shapes."""
    rings = F.flatten(
        F.transform(
            polygons,
            lambda poly: F.transform(
                poly,
                lambda ring, i: _ring_moments(
                    ring, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
                ),
            ),
        )
    )
    total = F.aggregate(rings, _zero("c", "x", "y"), lambda s, r: _plus(s, r, "c", "x", "y"))
    return F.struct(
        F.try_divide(total["x"], total["c"]).alias("lon"),
        F.try_divide(total["y"], total["c"]).alias("lat"),
    )


def polygon_centroid(text: Column) -> Column:
    """struct<lon, lat> of a boundary text; NULL for a bad shape."""
    polygons = geojson_polygons(text)
    return F.when(valid_polygons(polygons), polygons_centroid(polygons))


def _point(point: Column) -> Column:
    """Unit vector of a [lon, lat] pair."""
    lon, lat = F.radians(F.get(point, F.lit(0))), F.radians(F.get(point, F.lit(1)))
    return F.struct(
        (F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z")
    )


def _cross(a: Column, b: Column) -> Column:
    return F.struct(
        (a["y"] * b["z"] - a["z"] * b["y"]).alias("x"),
        (a["z"] * b["x"] - a["x"] * b["z"]).alias("y"),
        (a["x"] * b["y"] - a["y"] * b["x"]).alias("z"),
    )


def _minus(a: Column, b: Column) -> Column:
    return F.struct(*[(a[n] - b[n]).alias(n) for n in "xyz"])


def _dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def _sum_of(vectors: Column) -> Column:
    return F.aggregate(vectors, _zero("x", "y", "z"), lambda s, v: _plus(s, v, "x", "y", "z"))


def _ring_vector(ring: Column) -> Column:
    """Integral of the position vector over the inside of a ring on the unit sphere, towards its side.

    By Stokes it is half the sum over edges of the arc length times the unit normal of the arc's
    plane, that is of ``arc / sin(arc) * a x b``. The part with factor one is summed over offsets from
    the first point, which keeps the digits that small shapes lose in differences of unit vectors.
    """
    points = F.transform(ring, _point)
    origin = F.get(points, F.lit(0))
    steps = F.size(ring) - 1

    def edge(a: Column, b: Column) -> Column:
        return F.struct(
            _cross(_minus(a, origin), _minus(b, origin)).alias("near"),
            _cross(a, b).alias("normal"),
            _dot(a, b).alias("dot"),
        )

    def vector(e: Column) -> Column:
        sine = F.sqrt(_dot(e["normal"], e["normal"]))
        short = (sine < 1e-3) & (e["dot"] > 0)
        # arc / sin(arc) - 1, by its series where the quotient has no digits left; opposite points have no arc
        more = F.when(short, sine * sine / 6 + sine * sine * sine * sine * 3 / 40).otherwise(
            F.try_divide(F.atan2(sine, e["dot"]), sine) - 1
        )
        return F.struct(*[((e["near"][n] + more * e["normal"][n]) / 2).alias(n) for n in "xyz"])

    edges = F.zip_with(F.slice(points, F.lit(1), steps), F.slice(points, F.lit(2), steps), edge)
    total = _sum_of(F.transform(edges, vector))
    # either way round: the inside is the side of the ring's own points
    sign = F.when(_dot(total, _sum_of(points)) < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.struct(*[(sign * total[n]).alias(n) for n in "xyz"])


def spherical_polygons_centroid(polygons: Column) -> Column:
    """struct<lon, lat> of valid polygons on the sphere; holes weigh negatively; NULL for flat shapes
    and for edges between opposite points."""
    def signed(ring: Column, i: Column) -> Column:
        weight = F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.transform(F.array(_ring_vector(ring)), lambda v: F.struct(*[(weight * v[n]).alias(n) for n in "xyz"]))

    rings = F.flatten(F.flatten(F.transform(polygons, lambda poly: F.transform(poly, signed))))
    # one binding, so the sum is formed once
    found = F.transform(
        F.array(_sum_of(rings)),
        lambda v: F.when(
            _dot(v, v) > 0,
            F.struct(
                F.degrees(F.atan2(v["y"], v["x"])).alias("lon"),
                F.degrees(F.atan2(v["z"], F.sqrt(v["x"] * v["x"] + v["y"] * v["y"]))).alias("lat"),
            ),
        ),
    )
    return F.get(found, F.lit(0))


def spherical_centroid(text: Column) -> Column:
    """struct<lon, lat> of a boundary text on the sphere; NULL for a bad shape."""
    polygons = geojson_polygons(text)
    return F.when(valid_polygons(polygons), spherical_polygons_centroid(polygons))
