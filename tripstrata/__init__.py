"""Spark-native operators for large tables of timed, geolocated trips."""

from tripstrata.config import MODEL, TABLES, THRESHOLDS

__all__ = ["MODEL", "TABLES", "THRESHOLDS"]
