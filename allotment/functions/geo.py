"""Coordinates and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import EARTH_RADIUS_KM


SIGNED_NUMBER = r"^-?(\d+[.]?\d*|[.]\d+)$"


def parse_coordinate(text: Column) -> Column:
    """Degrees from noisy text: keep digits, dot and minus; NULL if no number is left."""
    kept = F.regexp_replace(F.trim(text), r"[^\d.\-]", "")
    return F.when(kept.rlike(SIGNED_NUMBER), kept).try_cast("double")


def great_circle_km(lat: Column, lon: Column, lat_to: Column, lon_to: Column) -> Column:
    """Haversine distance; NULL as soon as one coordinate is NULL."""
    half_lat = (F.radians(lat_to) - F.radians(lat)) / 2
    half_lon = (F.radians(lon_to) - F.radians(lon)) / 2
    chord = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat)) * F.cos(F.radians(lat_to)) * F.sin(half_lon) * F.sin(half_lon)
    )
    known = lat.isNotNull() & lon.isNotNull() & lat_to.isNotNull() & lon_to.isNotNull()
    # Rounding can push the chord past 1 for antipodes, where asin is NaN and
    # NaN would win every max(). least() skips NULL, hence the explicit guard.
    return F.when(known, 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(chord))))
