"""Projected metres -> latitude/longitude, and decoding of point geometries.

Mainland positions use the national conic grid, overseas departments their UTM zone. All formulas
are native column math; only the binary point decoder needs Python, batched through Arrow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# GRS80 ellipsoid, national conic grid, UTM zones of overseas departments.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
GRID = {"lat1": 44.0, "lat2": 49.0, "lat0": 46.5, "lon0": 3.0, "x0": 700000.0, "y0": 6600000.0}
UTM_SCALE = 0.9996
UTM_EASTING = 500000.0
UTM_SOUTH_NORTHING = 10000000.0
# department: (central meridian, southern hemisphere)
UTM_ZONES = {
    "971": (-63.0, False),
    "972": (-63.0, False),
    "973": (-51.0, False),
    "974": (57.0, True),
    "975": (-57.0, False),
    "976": (45.0, True),
}
# Reference systems by their public registry number; the national grid, geographic
# coordinates, and the UTM zones as (central meridian, southern hemisphere).
GRID_SRID = 2154
GEOGRAPHIC_SRIDS = (4326, 4171, 4258)
UTM_SRIDS = {
    5490: (-63.0, False), 4467: (-57.0, False), 2972: (-51.0, False), 2975: (57.0, True),
    4471: (45.0, True),
}
MAINLAND = r"^(?:[0-9]{2}|2[AB])$"

ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))


def _isometric(lat: float) -> float:
    return math.atanh(math.sin(lat)) - ECCENTRICITY * math.atanh(ECCENTRICITY * math.sin(lat))


def _parallel(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (ECCENTRICITY * math.sin(lat)) ** 2)


_LAT0, _LAT1, _LAT2 = (math.radians(GRID[k]) for k in ("lat0", "lat1", "lat2"))
CONE = math.log(_parallel(_LAT1) / _parallel(_LAT2)) / (_isometric(_LAT2) - _isometric(_LAT1))
CONE_RADIUS = SEMI_MAJOR * _parallel(_LAT1) / CONE * math.exp(CONE * _isometric(_LAT1))
APEX_Y = GRID["y0"] + CONE_RADIUS * math.exp(-CONE * _isometric(_LAT0))


def grid_to_latlon(x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse conic projection; six fixed-point steps reach sub-millimetre latitude."""
    dx, dy = x - GRID["x0"], F.lit(APEX_Y) - y
    lon = F.degrees(F.atan2(dx, dy) / CONE) + GRID["lon0"]
    iso = -F.log(F.sqrt(dx * dx + dy * dy) / CONE_RADIUS) / CONE
    lat = 2 * F.atan(F.exp(iso)) - math.pi / 2
    for _ in range(6):
        bent = iso + ECCENTRICITY * F.atanh(ECCENTRICITY * F.sin(lat))
        lat = 2 * F.atan(F.exp(bent)) - math.pi / 2
    return F.degrees(lat), lon


def utm_series() -> tuple[float, tuple[float, ...], tuple[float, ...]]:
    """Rectifying radius and the series coefficients of the inverse transverse Mercator."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    return radius, beta, delta


def utm_to_latlon(
    x: Column, y: Column, meridian: Column | float, northing: Column | float
) -> tuple[Column, Column]:
    radius, beta, delta = utm_series()
    xi = (y - northing) / (UTM_SCALE * radius)
    eta = (x - UTM_EASTING) / (UTM_SCALE * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, start=1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.degrees(lat), F.degrees(lon) + meridian


def _zones(department: Column, srid: Column) -> tuple[Column, Column]:
    """(central meridian, false northing) of the UTM zone that applies, NULL if none does."""
    meridian, south = F.lit(None).cast("double"), F.lit(False)
    rows = [((srid == 0) & (department == code), zone) for code, zone in UTM_ZONES.items()]
    rows += [(srid == number, zone) for number, zone in UTM_SRIDS.items()]
    for first, below in ((32600, False), (32700, True)):  # the worldwide numbering
        rows.append((srid.between(first + 1, first + 60), ((srid - first) * 6.0 - 183.0, below)))
    for own, (degrees, below) in rows:
        meridian = F.when(own, degrees).otherwise(meridian)
        south = F.when(own, F.lit(below)).otherwise(south)
    return meridian, F.when(south, UTM_SOUTH_NORTHING).otherwise(0.0)


def with_latlon(df: DataFrame, x: str, y: str, department: str, srid: str | None = None) -> DataFrame:
    """Adds ``latitude`` and ``longitude`` of a position.

    The value's own reference system decides; an unknown one gives NULL. Without one (NULL or 0)
    the grid of the department is taken; an unknown department gives NULL.
    """
    known = F.coalesce(F.col(srid), F.lit(0)) if srid else F.lit(0)
    meridian, northing = _zones(F.col(department), F.col("__srid"))
    # columns of their own: inside the series they would be repeated hundreds of times
    ready = (
        df.withColumns({"__srid": known, "__x": F.col(x), "__y": F.col(y)})
        .withColumns({"__meridian": meridian, "__northing": northing})
    )
    px, py, own = F.col("__x"), F.col("__y"), F.col("__srid")
    grid = ((own == 0) & F.col(department).rlike(MAINLAND)) | (own == GRID_SRID)
    systems = (
        (grid, grid_to_latlon(px, py)),
        (own.isin(*GEOGRAPHIC_SRIDS), (py, px)),
        (F.col("__meridian").isNotNull(), utm_to_latlon(px, py, F.col("__meridian"), F.col("__northing"))),
    )
    lat = lon = F.lit(None).cast("double")
    for applies, (a, b) in reversed(systems):
        lat, lon = F.when(applies, a).otherwise(lat), F.when(applies, b).otherwise(lon)
    there = px.isNotNull() & py.isNotNull()
    placed = ready.withColumns({"latitude": F.when(there, lat), "longitude": F.when(there, lon)})
    return placed.drop("__srid", "__x", "__y", "__meridian", "__northing")


POSITION = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("srid", T.IntegerType()),
    ]
)

_SRID_FLAG = 0x20000000
_POINT, _MULTIPOINT = 1, 4


def _mean_position(hexes: pd.Series) -> pd.DataFrame:
    """Mean x, y and reference system of hex EWKB points; one layout is decoded at a time.

    Text that is no hex, or no POINT or MULTIPOINT in two dimensions, gives NULL.
    """
    out = np.full((len(hexes), 3), np.nan)
    text = hexes.fillna("").astype(str)
    # two digits for each byte, byte order and kind first
    fine = text.str.fullmatch("(?:[0-9A-Fa-f]{2}){5,}").to_numpy(dtype=bool)
    layouts = pd.DataFrame({"head": text.str[:10], "size": text.str.len()})[fine]
    for (head, size), rows in layouts.groupby(["head", "size"]).indices.items():
        where = np.flatnonzero(fine)[rows]
        little = head[:2] == "01"
        order = "<" if little else ">"
        kind = int.from_bytes(bytes.fromhex(head[2:]), "little" if little else "big")
        has_srid = bool(kind & _SRID_FLAG)
        start = 9 if has_srid else 5
        kind &= ~_SRID_FLAG
        raw = np.frombuffer(bytes.fromhex("".join(text.iloc[where])), dtype=np.uint8)
        raw = raw.reshape(len(where), size // 2)
        if kind == _POINT and size // 2 == start + 16:
            body = raw[:, start:]
        elif kind == _MULTIPOINT and (size // 2 - start - 4) % 21 == 0 and size // 2 > start + 4:
            # every member repeats a five-byte header before its two doubles
            body = raw[:, start + 4:].reshape(len(where), -1, 21)[:, :, 5:].reshape(len(where), -1)
        else:
            continue
        xy = np.ascontiguousarray(body).view(f"{order}f8").reshape(len(where), -1, 2)
        out[where, :2] = xy.mean(axis=1)
        if has_srid:
            out[where, 2] = np.ascontiguousarray(raw[:, 5:9]).view(f"{order}u4")[:, 0] % 2**31
    frame = pd.DataFrame(out, columns=["x", "y", "srid"])
    return frame.astype(object).where(frame.notna(), None)


@F.pandas_udf(POSITION)
def ewkb_position(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Mean position of a POINT or MULTIPOINT given as hex EWKB; other geometries -> NULL."""
    for hexes in batches:
        yield _mean_position(hexes)
