"""Product layer: features, split, zones, analytics, demand and model tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import MODEL, TABLES, THRESHOLDS, TableNames, Thresholds
from tripstrata.functions.calendar import temporal_features, temporal_split
from tripstrata.functions.geo import geo_features, near_any, speed_kmh
from tripstrata.functions.numeric import duration_min
from tripstrata.operators.demand import demand_aggregate, split_share
from tripstrata.operators.quality import (
    assert_conserved, assert_no_leakage, conservation_check, select_whitelist,
)
from tripstrata.operators.zones import centroid_table, centroids_of, fit_zones, zone_assign
from tripstrata.sources.staging import drop_stage, stage_table
from tripstrata.sources.writers import overwrite_partitioned, overwrite_table


@dataclass
class GoldFrames:
    analytics: DataFrame
    demand: DataFrame
    features: DataFrame
    shares: DataFrame
    centroids: list


def enrich(clean: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    """Calendar and distance features, site flag and time split."""
    near = near_any(sites=t.sites, radius_km=t.site_radius_km, km_lat=t.km_per_deg_lat, km_lon=t.km_per_deg_lon)
    return geo_features(temporal_features(clean)).withColumns({
        "es_aeropuerto": near,
        "split_flag": temporal_split("pickup_datetime", t.split_cutoff),
    })


def analytics_frame(zoned: DataFrame) -> DataFrame:
    """Trip grain with speed and minutes, which derive from the target and stay out of the features."""
    return zoned.withColumns({
        "velocidad_kmh": speed_kmh(F.col("distancia_haversine_km"), F.col("trip_duration")),
        "duracion_min": duration_min(F.col("trip_duration")),
    })


def gold_frames(enriched: DataFrame, centroids: Sequence[tuple[float, float]]) -> GoldFrames:
    zoned = zone_assign(enriched, centroids)
    features = select_whitelist(zoned)
    assert_no_leakage(features.columns)
    return GoldFrames(analytics_frame(zoned), demand_aggregate(zoned), features, split_share(enriched), list(centroids))


def run_gold(spark: SparkSession, tables: TableNames = TABLES, t: Thresholds = THRESHOLDS,
             rebalance: bool = False, centroids: Sequence[tuple[float, float]] | None = None) -> GoldFrames:
    """Clean table to the three product tables; ``rebalance`` evens out the files of the partitioned ones.

    Zones are fitted on the staged enriched rows, unless ``centroids`` of an earlier run are given, so that later
    batches get the same zones; the centres are kept as a table. Assigning them is an expression, so it
    needs no second stage. Every check reads what was written.
    """
    clean = spark.table(tables.clean)
    enriched = stage_table(enrich(clean, t), "enriched")
    centroids = centroids_of(fit_zones(enriched, k=t.zones, seed=t.seed)) if centroids is None else list(centroids)
    overwrite_table(centroid_table(clean, centroids), tables.zones)
    frames = gold_frames(enriched, centroids)
    analytics = overwrite_partitioned(frames.analytics, tables.analytics, "pickup_month", rebalance=rebalance)
    demand = overwrite_table(frames.demand, tables.demand)
    features = overwrite_partitioned(frames.features, tables.features, "split_flag", rebalance=rebalance)
    assert_no_leakage(features.columns)
    assert_conserved(
        conservation_check(clean, {"trips_analytics": analytics, "trips_features": features}, features, MODEL.whitelist))
    drop_stage(enriched)
    return GoldFrames(analytics, demand, features, split_share(features), centroids)
