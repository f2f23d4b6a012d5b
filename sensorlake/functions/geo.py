"""Geographic math as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Radii in km and the degree-length series in metres.
EARTH_RADIUS_KM = 6371.0
EQUATOR_RADIUS_KM = 6378.137
POLE_RADIUS_KM = 6356.752
DEGREE_SERIES_M = (111132.954, -559.822, 1.175)


def degree_length_km(lat: Column) -> tuple[Column, Column]:
    """Length of one degree of latitude and of longitude at ``lat``."""
    c0, c2, c4 = DEGREE_SERIES_M
    phi = F.radians(lat)
    lat_km = (F.lit(c0) + F.lit(c2) * F.cos(phi * 2) + F.lit(c4) * F.cos(phi * 4)) / 1000
    reduced = F.atan(F.lit(POLE_RADIUS_KM / EQUATOR_RADIUS_KM) * F.tan(phi))
    return lat_km, F.radians(F.lit(1.0)) * EQUATOR_RADIUS_KM * F.cos(reduced)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def centroid(lat: Column, lon: Column) -> Column:
    """Aggregate: ``struct(lat, lon)`` of the mean unit vector."""
    phi, lam = F.radians(lat), F.radians(lon)
    x, y, z = F.avg(F.cos(phi) * F.cos(lam)), F.avg(F.cos(phi) * F.sin(lam)), F.avg(F.sin(phi))
    return F.struct(
        F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("lat"),
        F.degrees(F.atan2(y, x)).alias("lon"))


def phase_difference(re1: Column, im1: Column, re2: Column, im2: Column) -> Column:
    """Aggregate: angle of the complex correlation of two signals, in radians, units of pi and degrees."""
    real = F.sum(re1 * re2 + im1 * im2)
    imag = F.sum(im1 * re2 - re1 * im2)
    angle = F.atan2(imag, real)
    return F.struct(
        angle.alias("phase_rad"),
        (angle / F.pi()).alias("phase_rad_pi"),
        F.degrees(angle).alias("phase_deg"))
