"""Great-circle distance and a latitude-banded grid for distance joins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6373.0  # fixed value: radius used for all distances

_SLACK = 1e-9


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _step(km: float) -> float:
    """Band height in degrees, a little more than ``km`` along a meridian."""
    return math.degrees(km / EARTH_KM) * (1 + 1e-6) + 1e-6


def _row(lat: Column, step: float) -> Column:
    return F.floor((lat + 90.0) / step)


def _columns_in(row: Column, step: float) -> Column:
    """Number of cells around the globe in one band, each at least ``step`` wide."""
    low = F.abs(row * step - 90.0)
    high = F.abs((row + 1) * step - 90.0)
    outer = F.least(F.greatest(low, high), F.lit(90.0))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(outer)) * (360.0 / step))).cast("long")


def _cell(row: Column, column: Column) -> Column:
    return F.struct(row.cast("long").alias("r"), column.cast("long").alias("c"))


def cell(lat: Column, lon: Column, km: float) -> Column:
    """Grid cell of a point; longitudes wrap at 180 degrees."""
    step = _step(km)
    row = _row(lat, step)
    count = _columns_in(row, step)
    column = F.pmod(F.floor((lon + 180.0) * count / 360.0), count)
    return _cell(row, column)


def reachable_cells(lat: Column, lon: Column, km: float) -> Column:
    """Array of all cells that may hold a point within ``km``."""
    step = _step(km)
    angle = km / EARTH_KM
    cos_lat = F.cos(F.radians(lat))
    ratio = F.lit(math.sin(min(angle, math.pi / 2))) / F.greatest(cos_lat, F.lit(1e-12))
    half = F.when((ratio >= 1) | F.lit(angle >= math.pi / 2), F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-6) + _SLACK
    )

    def band(shift: int) -> Column:
        row = _row(lat, step) + shift
        count = _columns_in(row, step)
        first = F.floor((lon - half + 180.0) * count / 360.0)
        last = F.floor((lon + half + 180.0) * count / 360.0)
        last = F.least(last, first + count - 1)
        return F.transform(F.sequence(first, last), lambda c: _cell(row, F.pmod(c, count)))

    return F.array_distinct(F.concat(band(-1), band(0), band(1)))
