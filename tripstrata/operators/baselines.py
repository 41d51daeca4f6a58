"""Group-median predictors: what a person with a spreadsheet would answer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.config import DISTANCE_CUTS, MODEL
from tripstrata.functions.numeric import bucket_right_closed
from tripstrata.operators.effects import one_row
from tripstrata.operators.quantiles import quantiles
from tripstrata.sources.staging import stage_table

CALENDAR_KEYS = ("pickup_hour", "pickup_dayofweek")
DISTANCE_KEYS = ("tramo", "pickup_hour")
# Valid durations are whole seconds of at most six hours: counting 21,600 values is a bounded task.
WHOLE_SECONDS = "discrete"


def group_median_model(train: DataFrame, keys: Sequence[str], target: str = MODEL.target,
                       domain: str = "continuous") -> tuple[DataFrame, DataFrame]:
    """(median of the target per key, one-row global median). Rows with an unknown key fit only the latter.

    ``discrete`` is for targets with a proven small number of values: the training rows are read once, counts per
    key and value are staged, and both medians come from those.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    if domain == "discrete":
        counts = stage_table(train.groupBy(*keys, target).agg(F.count(F.lit(1)).alias("_rows")), "fitted")
        train, options = counts, {"domain": domain, "weight": "_rows"}
    else:
        options = {"domain": domain}
    table = quantiles(train.filter(known), keys, target, [0.5], ["mediana"], **options).drop("n")
    overall = quantiles(train, [], target, [0.5], ["mediana_global"], **options).drop("n")
    return table, overall


def lookup_predict(df: DataFrame, model: tuple[DataFrame, DataFrame], keys: Sequence[str], output: str = "pred",
                   keys_bounded: bool = False) -> DataFrame:
    """Median of the row's group, or the global one where the group was never seen.

    ``keys_bounded`` is for keys with a small proven number of values (hour and weekday:
    168 groups; band and hour: 192), whose table is broadcast. Otherwise adaptive
    execution decides by measured size and splits a hot key of the shuffled join.
    """
    table, overall = model
    table = F.broadcast(table) if keys_bounded else table
    return (
        df.join(table, list(keys), "left")
        .withColumn(output, F.coalesce("mediana", one_row(overall)["mediana_global"]))
        .drop("mediana")
    )


def calendar_baseline(train: DataFrame, df: DataFrame, output: str = "pred") -> DataFrame:
    """Median by hour and weekday."""
    return lookup_predict(df, group_median_model(train, CALENDAR_KEYS, domain=WHOLE_SECONDS), CALENDAR_KEYS, output, keys_bounded=True)


def distance_hour_baseline(train: DataFrame, df: DataFrame, output: str = "pred",
                           distance: str = "distancia_haversine_km", cuts: Sequence[float] = DISTANCE_CUTS) -> DataFrame:
    """Median by distance band and hour. Distance 0 lies in no band and gets the global median."""
    band = bucket_right_closed(F.col(distance), cuts)
    model = group_median_model(train.withColumn("tramo", band), DISTANCE_KEYS, domain=WHOLE_SECONDS)
    return lookup_predict(df.withColumn("tramo", band), model, DISTANCE_KEYS, output, keys_bounded=True).drop("tramo")


def attach_dates(df: DataFrame, analytics: DataFrame, key: str = "id", ts: str = "pickup_datetime") -> DataFrame:
    """Fetch the pickup date, which is not a feature, to cut validation windows."""
    return df.join(analytics.select(key, F.to_date(ts).alias("fecha")), key, "left")
