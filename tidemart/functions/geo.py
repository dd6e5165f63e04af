"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.scalar import ColumnOrName, column

# Mean radius in miles, length of a unit in miles.
EARTH_RADIUS_MILES = 3961
UNITS = {"mi": 1.0, "km": 1.60934}


def degrees_to_radians(degrees: ColumnOrName) -> Column:
    return F.radians(column(degrees))


def haversine_distance(
    lat1: ColumnOrName,
    lon1: ColumnOrName,
    lat2: ColumnOrName,
    lon2: ColumnOrName,
    unit: str = "mi",
) -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, got {unit!r}")
    lat1, lon1, lat2, lon2 = (column(c) for c in (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        s = F.sin(F.radians((b - a) / 2))
        return s * s

    h = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * half_chord(lon1, lon2)
    # Rounding can lift the value for antipodes a hair above 1.
    h = F.least(h, F.lit(1.0))
    return F.asin(F.sqrt(h)) * (2 * EARTH_RADIUS_MILES) * UNITS[unit]
