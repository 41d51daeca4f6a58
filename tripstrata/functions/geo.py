"""Distances, bearings and proximity as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.config import DROPOFF, EARTH_RADIUS_KM, PICKUP, THRESHOLDS


def _half_chord(delta_deg: Column) -> Column:
    half = F.sin(F.radians(delta_deg) / 2)
    return half * half


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance. The chord is held at 1, beyond which rounding would give NaN."""
    chord = _half_chord(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _half_chord(lon2 - lon1)
    return F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * (2 * EARTH_RADIUS_KM)


def manhattan_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """North-south leg at the first longitude plus east-west leg at the first latitude."""
    return haversine_km(lat1, lon1, lat2, lon1) + haversine_km(lat1, lon1, lat1, lon2)


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from north, in [0, 360)."""
    turn = F.radians(lon2 - lon1)
    from_lat, to_lat = F.radians(lat1), F.radians(lat2)
    east = F.sin(turn) * F.cos(to_lat)
    north = F.cos(from_lat) * F.sin(to_lat) - F.sin(from_lat) * F.cos(to_lat) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360, F.lit(360.0))


def geo_features(df: DataFrame, origin=PICKUP, destination=DROPOFF) -> DataFrame:
    """Great-circle distance, grid distance and bearing of each trip."""
    ends = [F.col(c) for c in (*origin, *destination)]
    return df.withColumns({
        "distancia_haversine_km": haversine_km(*ends),
        "distancia_manhattan_km": manhattan_km(*ends),
        "bearing_deg": bearing_deg(*ends),
    })


def near_site(lat: Column, lon: Column, site: tuple, radius_km: float = THRESHOLDS.site_radius_km,
              km_lat: float = THRESHOLDS.km_per_deg_lat, km_lon: float = THRESHOLDS.km_per_deg_lon) -> Column:
    """Whether a point lies within a planar radius of a site, the edge included."""
    north, east = (lat - site[0]) * km_lat, (lon - site[1]) * km_lon
    return north * north + east * east <= radius_km * radius_km


def near_any(points: Iterable[tuple[str, str]] = (PICKUP, DROPOFF), sites: dict = THRESHOLDS.sites,
             **scale) -> Column:
    """1 when any of the points is near any of the sites, else 0.

    The sites are literals of the expression, so no join is needed for the few there are.
    """
    checks = [near_site(F.col(lat), F.col(lon), site, **scale) for site in sites.values() for lat, lon in points]
    return F.when(reduce(or_, checks), 1).otherwise(0)


def speed_kmh(km: Column, seconds: Column) -> Column:
    """Mean speed, 0 when no time passed. Derived from the target: for analysis, never a model input."""
    return F.when(seconds > 0, km / (seconds / 3600.0)).otherwise(F.lit(0.0))


def nearest(lat: Column, lon: Column, centroids: list[tuple[float, float]]) -> Column:
    """Index of the nearest centroid, the lower index on a tie.

    Centroids are literals of the expression (there are only as many as zones), so
    assigning a zone needs neither a join nor a model object.
    """
    def square(side):
        return side * side

    distances = F.array(*[square(lat - c_lat) + square(lon - c_lon) for c_lat, c_lon in centroids])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
