"""Distances on a sphere and the boxes that bound them."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed values.
EARTH_KM = 6371.0
KM_PER_LAT_DEGREE = 110.574
KM_PER_LON_DEGREE = 111.320
BOX_SLACK = 1.2
MAX_RADIUS_KM = 15.0
COUNTRY_BOX = {"lat_min": 29.3, "lat_max": 33.5, "lon_min": 34.1, "lon_max": 35.9}


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def box_degrees(lat: float, radius_km: float) -> tuple[float, float]:
    """Half-height and half-width in degrees of a box around a circle."""
    lon_km = KM_PER_LON_DEGREE * max(math.cos(math.radians(lat)), 0.01)
    return radius_km / KM_PER_LAT_DEGREE * BOX_SLACK, radius_km / lon_km * BOX_SLACK


def inside_country(lat: Column, lon: Column) -> Column:
    return lat.between(COUNTRY_BOX["lat_min"], COUNTRY_BOX["lat_max"]) & lon.between(
        COUNTRY_BOX["lon_min"], COUNTRY_BOX["lon_max"]
    )


def cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")
