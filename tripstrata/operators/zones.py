"""Zones of the city: k-means on pickups, assignment of both trip ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.config import DROPOFF, PICKUP, THRESHOLDS, TRAIN
from tripstrata.functions.geo import nearest


def fit_zones(df: DataFrame, point: tuple[str, str] = PICKUP, k: int = THRESHOLDS.zones, seed: int = THRESHOLDS.seed,
              split: str = "split_flag") -> KMeansModel:
    """k-means on the pickups of the training split only, so zones know nothing of the test period.

    Equal points are merged first and weighted by their count: the same objective, with
    a busy spot iterated over once instead of once per trip.
    """
    lat, lon = point
    spots = (
        df.filter((F.col(split) == TRAIN) & F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(lat, lon).agg(F.count(F.lit(1)).cast("double").alias("peso"))
    )
    vectors = VectorAssembler(inputCols=[lat, lon], outputCol="coords").transform(spots)
    return KMeans(featuresCol="coords", predictionCol="zona", weightCol="peso", k=k, seed=seed).fit(vectors)


def centroids_of(model: KMeansModel) -> list[tuple[float, float]]:
    """Zone centres: as many pairs of numbers as there are zones."""
    return [(float(c[0]), float(c[1])) for c in model.clusterCenters()]


def centroid_table(df: DataFrame, centroids: Sequence[tuple[float, float]]) -> DataFrame:
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(centroids)]
    return df.sparkSession.createDataFrame(rows, "zona int, latitud double, longitud double")


def zone_assign(df: DataFrame, centroids: Sequence[tuple[float, float]], origin: tuple[str, str] = PICKUP,
                destination: tuple[str, str] = DROPOFF) -> DataFrame:
    """Nearest zone of both ends from the same centres, so a zone means the same as origin and destination."""
    return df.withColumns({
        "pickup_cluster": nearest(F.col(origin[0]), F.col(origin[1]), list(centroids)),
        "dropoff_cluster": nearest(F.col(destination[0]), F.col(destination[1]), list(centroids)),
    })
