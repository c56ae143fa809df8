"""Hex points as dumps store them, for the trial tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reference system in which a department's points are stored; all others use the national grid.
OVERSEAS_SRID = {"971": 5490, "972": 5490, "973": 2972, "974": 2975, "975": 4467, "976": 4471}
_POINT_WITH_SRID = 0x20000001


def srid_of(department: Column) -> Column:
    out = F.lit(2154)
    for code, srid in OVERSEAS_SRID.items():
        out = F.when(department == code, F.lit(srid)).otherwise(out)
    return out


@F.pandas_udf(T.StringType())
def point_ewkb(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """x, y, reference system -> hex EWKB point."""
    layout = np.dtype([("order", "u1"), ("kind", "<u4"), ("srid", "<u4"), ("x", "<f8"), ("y", "<f8")])
    for x, y, srid in batches:
        rows = np.zeros(len(x), layout)
        rows["order"], rows["kind"], rows["srid"], rows["x"], rows["y"] = 1, _POINT_WITH_SRID, srid, x, y
        text, width = rows.tobytes().hex().upper(), 2 * layout.itemsize
        yield pd.Series([text[i * width : (i + 1) * width] for i in range(len(x))])
