"""Spherical geometry as column expressions. All functions return NULL when an input is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from routeline.functions.values import rounded

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0


def _sin_sq(angle: Column) -> Column:
    return F.sin(angle) * F.sin(angle)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column,
                 form: str = "atan2") -> Column:
    """Great-circle distance. Both forms clamp rounding noise for (anti)podal points."""
    h = _sin_sq(F.radians(lat2 - lat1) / 2.0) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _sin_sq(F.radians(lng2 - lng1) / 2.0)
    )
    if form == "asin":
        half_angle = F.asin(F.sqrt(F.when(h > 1.0, F.lit(1.0)).otherwise(h)))
    elif form == "atan2":
        half_angle = F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(0.0), 1.0 - h)))
    else:
        raise ValueError("form must be 'atan2' or 'asin'")
    return half_angle * (2.0 * EARTH_RADIUS_KM)


def equirect_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column,
                scale_lat: Column) -> Column:
    """Flat-earth distance with longitudes shrunk at ``scale_lat``; fine for short hops."""
    north = lat2 - lat1
    east = (lng2 - lng1) * F.cos(F.radians(scale_lat))
    return F.sqrt(north * north + east * east) * KM_PER_DEGREE


def bearing_deg(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Initial compass bearing in [0, 360)."""
    p1, p2, turn = F.radians(lat1), F.radians(lat2), F.radians(lng2 - lng1)
    east = F.sin(turn) * F.cos(p2)
    north = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def move_point(lat: Column, lng: Column, bearing: Column, km: Column) -> tuple[Column, Column]:
    """(latitude, longitude) reached after travelling ``km`` along ``bearing``."""
    arc = km / EARTH_RADIUS_KM
    p, course = F.radians(lat), F.radians(bearing)
    sin_p2 = F.sin(p) * F.cos(arc) + F.cos(p) * F.sin(arc) * F.cos(course)
    shift = F.atan2(F.sin(course) * F.sin(arc) * F.cos(p), F.cos(arc) - F.sin(p) * sin_p2)
    return F.degrees(F.asin(sin_p2)), F.degrees(F.radians(lng) + shift)


def geo_cell(lat: Column, lng: Column, resolution: int = 9) -> Column:
    """Text key of the 0.01-degree cell, in the fixed format ``h3_<res>_<lat>_<lng>``."""
    return F.concat(
        F.lit(f"h3_{resolution}_"),
        rounded(lat, 2).cast("string"), F.lit("_"), rounded(lng, 2).cast("string"),
    )
