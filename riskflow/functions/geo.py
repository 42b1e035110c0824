"""Great-circle distance and grid cells as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used by every distance in this library.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees; NULL if any part is NULL."""
    north_south = F.sin(F.radians(lat2 - lat1) / 2)
    east_west = F.sin(F.radians(lon2 - lon1) / 2)
    chord = north_south * north_south + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east_west * east_west
    )
    # Rounding can push the term just outside [0, 1]; least/greatest skip NULLs, so guard them.
    inside = F.when(chord.isNotNull(), F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0)))
    return F.asin(F.sqrt(inside)) * F.lit(2 * EARTH_RADIUS_KM)


def grid_cell(lat: Column, lon: Column, decimals: int = 3) -> Column:
    """``"lat,lon"`` rounded to a cell (three decimals is about 100 m); NULL-propagating."""
    parts = [F.round(axis, decimals).cast("string") for axis in (lat, lon)]
    return F.concat(parts[0], F.lit(","), parts[1])
