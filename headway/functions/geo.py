"""Geographic column expressions: haversine distance and radius-sized grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "EARTH_RADIUS_M",
    "METERS_PER_DEG_LAT",
    "cell_size_deg",
    "grid_cell",
    "haversine_m",
    "neighbour_cells",
]

# Mean Earth radius in metres used by the distance formula.
EARTH_RADIUS_M = 6371000.0
METERS_PER_DEG_LAT = math.pi * EARTH_RADIUS_M / 180.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres (C21); ``a`` is clamped to 1 for safety."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = F.radians(_c(lat2) - _c(lat1))
    dl = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cell_size_deg(radius_m: float, max_abs_lat: float) -> tuple[float, float]:
    """(dlat, dlon) in degrees so that any two points within ``radius_m`` lie in
    the same or a neighbouring cell, for latitudes up to ``max_abs_lat``.

    The cell is padded by 1 % against rounding; dlon widens with latitude.
    """
    dlat = 1.01 * radius_m / METERS_PER_DEG_LAT
    lat = min(89.0, abs(max_abs_lat) + dlat)
    dlon = dlat / math.cos(math.radians(lat))
    return dlat, dlon


def grid_cell(lat, lon, dlat: float, dlon: float) -> tuple[Column, Column]:
    """Integer cell coordinates (cy, cx) (C23, exact replacement of decimal rounding)."""
    return (
        F.floor(_c(lat) / F.lit(dlat)).cast("long"),
        F.floor(_c(lon) / F.lit(dlon)).cast("long"),
    )


def neighbour_cells(cy: Column, cx: Column) -> Column:
    """The 3 x 3 block of cells around (cy, cx) as an array of structs."""
    return F.array(
        *[
            F.struct((cy + dy).alias("cy"), (cx + dx).alias("cx"))
            for dy in (-1, 0, 1)
            for dx in (-1, 0, 1)
        ]
    )
