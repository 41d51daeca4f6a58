"""Demand by zone, hour, weekday and day; concentration, flows and regimes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import DROPOFF, PICKUP, THRESHOLDS
from tripstrata.functions.geo import near_any
from tripstrata.operators.effects import one_row
from tripstrata.operators.ordering import running_total
from tripstrata.operators.quantiles import lower_quantiles, quantiles
from tripstrata.sources.staging import stage_table


def split_share(df: DataFrame, split: str = "split_flag") -> DataFrame:
    """Rows of each split and their share of all rows, from one count per split."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    # One row per split.
    return counts.withColumn("pct", F.col("n") / F.sum("n").over(W.partitionBy()) * 100)


def demand_aggregate(df: DataFrame, keys: Sequence[str] = ("pickup_cluster", "pickup_hour", "pickup_dayofweek")) -> DataFrame:
    """Trips, median duration and distance, mean passengers, typical speed and minutes per key.

    Medians are exact and lower: the smallest value that half of the group does not exceed. No group is gathered
    and no sketch is held per group; the narrowing search for distances runs two jobs when this is called.
    """
    keys = list(keys)
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_viajes"),
        F.round(F.avg("passenger_count"), 2).alias("pasajeros_promedio"),
    )
    for value, name in (("trip_duration", "duracion_mediana_seg"), ("distancia_haversine_km", "distancia_mediana_km")):
        grouped = _with_median(grouped, df, keys, value, name)
    return demand_columns(grouped, keys)


def demand_columns(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The demand table from its counts, mean and medians."""
    grouped = grouped.select(*keys, "n_viajes", "duracion_mediana_seg", "distancia_mediana_km", "pasajeros_promedio")
    hours = F.col("duracion_mediana_seg") / 3600.0
    return grouped.withColumns({
        "velocidad_mediana_kmh": F.round(F.try_divide(F.col("distancia_mediana_km"), hours), 2),
        "duracion_mediana_min": F.round(F.col("duracion_mediana_seg") / 60.0, 2),
    })


def join_keys(groups: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``groups`` with what is ``found`` for some of them; NULL keys match."""
    found = found.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [groups[k].eqNullSafe(found[f"_{k}"]) for k in keys])
    return groups.join(found, same, "left").drop(*[f"_{k}" for k in keys])


def _with_median(groups: DataFrame, rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``groups`` with the lower median of ``value``, in the type of the column."""
    found = lower_quantiles(rows, keys, value, [0.5], [name]).drop("n")
    return join_keys(groups, found, keys).withColumn(name, F.col(name).cast(rows.schema[value].dataType))


def hour_profile(demand: DataFrame) -> DataFrame:
    """Trips and trip-weighted speed and minutes per hour, from the demand table."""
    def weighted(column):
        return F.sum(F.col(column) * F.col("n_viajes")) / F.sum("n_viajes")

    return demand.groupBy("pickup_hour").agg(
        F.sum("n_viajes").alias("viajes"),
        weighted("velocidad_mediana_kmh").alias("vel"),
        weighted("duracion_mediana_min").alias("dur"),
    ).orderBy("pickup_hour")


def slow_fast_hour(profile: DataFrame) -> DataFrame:
    """Slowest and fastest hour and their ratio; the earlier hour wins a tie."""
    return profile.agg(
        F.min(F.struct("vel", "pickup_hour")).alias("lenta"),
        F.max(F.struct(F.col("vel"), (-F.col("pickup_hour")).alias("h"))).alias("rapida"),
    ).select(
        F.col("lenta.pickup_hour").alias("hora_lenta"),
        F.col("lenta.vel").alias("vel_lenta"),
        (-F.col("rapida.h")).alias("hora_rapida"),
        F.col("rapida.vel").alias("vel_rapida"),
        F.try_divide(F.col("rapida.vel"), F.col("lenta.vel")).alias("razon"),
    )


def daily_series(df: DataFrame, ts: str = "pickup_datetime", speed: str = "velocidad_kmh") -> DataFrame:
    """Trips and exact lower median speed per day."""
    dated = df.select(F.to_date(ts).alias("fecha"), speed)
    counts = dated.groupBy("fecha").agg(F.count(F.lit(1)).alias("viajes"))
    return _with_median(counts, dated, ["fecha"], speed, "vel").select("fecha", "viajes", "vel")


def moving_average(daily: DataFrame, value: str = "viajes", day: str = "fecha", width: int = 7,
                   output: str = "media_movil") -> DataFrame:
    """Centred moving average over rows; NULL unless the window is full.

    Works on one row per day: ten years are 3,650 rows, so one ordered task is enough.
    """
    half = width // 2
    window = W.orderBy(day).rowsBetween(-half, half)
    return daily.withColumn(
        output, F.when(F.count(value).over(window) == 2 * half + 1, F.avg(value).over(window))
    )


def weekday_variance_share(daily: DataFrame, value: str = "viajes", day: str = "fecha") -> DataFrame:
    """Variance of the weekday means, placed on each day, over the variance of the days."""
    placed = daily.withColumn("_mean", F.avg(value).over(W.partitionBy(F.dayofweek(day))))
    return placed.agg(F.try_divide(F.var_samp("_mean"), F.var_samp(value)).alias("prop_varianza_dia_semana"))


def extreme_day(daily: DataFrame, value: str = "viajes", day: str = "fecha") -> DataFrame:
    """The day with fewest trips (the first on a tie), the median day and their ratio.

    Reads ``daily`` twice: pass a staged series where it comes from a large table.
    """
    middle = one_row(quantiles(daily, [], value, [0.5], ["mediana"], "discrete"))
    return (
        daily.agg(F.min(F.struct(value, day)).alias("low"), F.count(F.lit(1)).alias("dias"))
        .withColumn("m", middle)
        .select(
            "dias",
            F.col("m.mediana").alias("mediana_diaria"),
            F.col(f"low.{day}").alias("dia_minimo"),
            F.col(f"low.{value}").alias("viajes_minimo"),
            (F.col(f"low.{value}") / F.col("m.mediana") * 100).alias("pct_de_la_mediana"),
        )
    )


def cumulative_share(counts: DataFrame, key: str, amount: str, keys_bounded: bool = True) -> DataFrame:
    """Running percentage of ``amount`` over keys, largest first.

    ``keys_bounded`` is for a small fixed number of keys (zones of a fitted model): one
    ordered task. Otherwise the keys are range-partitioned and each range continues from
    the total of the ones before it.
    """
    order = [F.desc(amount), F.col(key)]
    if keys_bounded:
        upto = F.sum(amount).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
        return counts.withColumn("pct_acum", upto / F.sum(amount).over(W.partitionBy()) * 100)
    counts = stage_table(counts, "counts")
    total = counts.agg(F.sum(amount).alias("t"))
    running = running_total(counts, order, amount, "_upto")
    return running.withColumn("pct_acum", F.col("_upto") / total.scalar() * 100).drop("_upto")


def zone_concentration(demand: DataFrame, zone: str = "pickup_cluster") -> DataFrame:
    """Trips per zone with their running share, from the demand table."""
    counts = demand.groupBy(zone).agg(F.sum("n_viajes").alias("viajes"))
    return cumulative_share(counts, zone, "viajes")


def top_share(concentration: DataFrame, share: str = "pct_acum", top: int = 3) -> DataFrame:
    """Percentage of the ``top`` largest keys: the running share at the last of them."""
    return concentration.orderBy(share).limit(top).agg(F.max(share).alias("pct_principales"))


def od_pairs_topk(df: DataFrame, k: int = 10, origin: str = "pickup_cluster",
                  destination: str = "dropoff_cluster") -> DataFrame:
    """The ``k`` most frequent origin-destination pairs; ties in key order."""
    return (
        df.groupBy(origin, destination).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), origin, destination).limit(k)
    )


def intra_zone_share(df: DataFrame, origin: str = "pickup_cluster", destination: str = "dropoff_cluster") -> DataFrame:
    """Share of trips that end in the zone they started in; unknown zones count as different."""
    same = F.coalesce(F.col(origin) == F.col(destination), F.lit(False))
    return df.agg(F.avg(same.cast("double")).alias("prop_intrazona"))


REGIME_MEASURES = ("duracion_min", "distancia_haversine_km", "velocidad_kmh")


def regime_profile(df: DataFrame, flag: str = "es_aeropuerto", measures: Sequence[str] = REGIME_MEASURES) -> DataFrame:
    """Rows and exact medians of the measures on either side of a flag."""
    return _medians(df.withColumn("grupo", F.col(flag).cast("string")), "grupo", measures)


def _medians(df: DataFrame, group: str, measures: Sequence[str]) -> DataFrame:
    long = df.select(group, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        [group], list(measures), "medida", "valor")
    found = quantiles(long, [group, "medida"], "valor", [0.5], ["mediana"])
    return found.groupBy(group).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("medida") == m, F.col("mediana"))).alias(f"mediana_{m}") for m in measures],
    )


def site_profile(df: DataFrame, sites: dict = THRESHOLDS.sites, points=(PICKUP, DROPOFF)) -> DataFrame:
    """Trips touching each site, their share and median minutes. A trip may touch several."""
    names = F.array(*[
        F.when(near_any(points, {name: place}) == 1, F.lit(name)) for name, place in sites.items()
    ])
    total = df.agg(F.count(F.lit(1)).alias("n"))
    touched = df.select(F.explode(F.array_compact(names)).alias("sitio"), "trip_duration")
    found = quantiles(touched, ["sitio"], "trip_duration", [0.5], ["mediana"], "discrete")
    return found.select(
        "sitio",
        "n",
        (F.col("n") / total.scalar() * 100).alias("pct"),
        (F.col("mediana") / 60.0).alias("mediana_min"),
    )
