"""Great-circle distance and bounds of it over a latitude/longitude box, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import EARTH_RADIUS_KM


def _km(chord: Column) -> Column:
    # rounding can lift the argument above 1 for antipodes, where asin is undefined; least() would turn a null into 1
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def _half_sine_squared(radians: Column) -> Column:
    return F.pow(F.sin(radians / 2), F.lit(2.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    chord = (_half_sine_squared(p1 - p2)
             + F.cos(p1) * F.cos(p2) * _half_sine_squared(F.radians(lon1) - F.radians(lon2)))
    return _km(chord)


def box_distance_km(lat: Column, lon: Column, lat_min: Column, lat_max: Column, lon_min: Column,
                    lon_max: Column) -> tuple[Column, Column]:
    """A lower and an upper bound of the distance from a point to anything inside a box."""
    zero = F.lit(0.0)
    dlat_lo = F.greatest(zero, lat_min - lat, lat - lat_max)
    dlat_hi = F.greatest(F.abs(lat - lat_min), F.abs(lat - lat_max))
    # longitude differences are circular: x and 360 - x are the same arc
    gap = F.greatest(zero, lon_min - lon, lon - lon_max)
    far = F.greatest(F.abs(lon - lon_min), F.abs(lon - lon_max))
    dlon_lo = F.least(gap, F.greatest(zero, F.lit(360.0) - far))
    dlon_hi = F.least(far, F.lit(180.0))
    edge = F.least(F.cos(F.radians(lat_min)), F.cos(F.radians(lat_max)))
    widest = F.when((lat_min <= 0) & (lat_max >= 0), F.lit(1.0)).otherwise(
        F.greatest(F.cos(F.radians(lat_min)), F.cos(F.radians(lat_max))))
    here = F.cos(F.radians(lat))
    low = _half_sine_squared(F.radians(dlat_lo)) + here * edge * _half_sine_squared(F.radians(dlon_lo))
    high = _half_sine_squared(F.radians(dlat_hi)) + here * widest * _half_sine_squared(F.radians(dlon_hi))
    return _km(low), _km(high)
