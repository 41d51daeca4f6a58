"""Exploratory report over whole tables: shape, effects, demand, flows and split check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import MODEL, TABLES, TableNames
from tripstrata.operators import demand as d
from tripstrata.operators import effects as e
from tripstrata.operators.drift import split_drift_check
from tripstrata.sources.staging import stage_table
from tripstrata.sources.writers import write_summary_json

CORRELATED = (
    ("distancia_haversine_km", "distancia_manhattan_km"),
    ("distancia_haversine_km", "bearing_deg"),
    ("pickup_hour", "velocidad_kmh"),
    ("pickup_hour", "log_dur"),
)


def with_logs(analytics: DataFrame) -> DataFrame:
    return analytics.withColumns({
        "log_dur": F.log1p("trip_duration"), "log_dist": F.log1p("distancia_haversine_km")})


def eda_frames(analytics: DataFrame, demand: DataFrame) -> dict[str, DataFrame]:
    """Every statistic of the report, each on all trips."""
    logs = with_logs(analytics)
    residual = e.with_residual(logs, "log_dist", "log_dur")
    profile = d.hour_profile(demand)
    daily = stage_table(d.daily_series(analytics), "daily")
    zones = d.zone_concentration(demand)
    factors = [f for f in MODEL.effect_factors if f in analytics.columns]
    return {
        "forma": e.distribution_shape(analytics, "trip_duration"),
        "ajuste_distancia": e.simple_regression(logs, "log_dist", "log_dur"),
        "dispersion": e.band_dispersion(analytics, "distancia_haversine_km", "trip_duration"),
        "efectos": e.effect_table(residual, "log_dur", "residuo", factors),
        "perfil_horario": profile,
        "horas_extremas": d.slow_fast_hour(profile),
        "regimen_aeropuerto": d.regime_profile(analytics),
        "aeropuertos": d.site_profile(analytics),
        "serie_diaria": d.moving_average(daily),
        "varianza_semanal": d.weekday_variance_share(daily),
        "dia_extremo": d.extreme_day(daily),
        "zonas": zones,
        "tres_zonas": d.top_share(zones),
        "pares_od": d.od_pairs_topk(analytics),
        "intrazona": d.intra_zone_share(analytics),
        "correlaciones": e.pearson(logs, CORRELATED),
        "deriva_split": split_drift_check(analytics, MODEL.split_checked),
    }


def eda_summary(analytics: DataFrame, source: str) -> DataFrame:
    """One row with the figures later steps compare against."""
    logs = with_logs(analytics)
    residual = e.with_residual(logs, "log_dist", "log_dur")
    factors = [f for f in MODEL.effect_factors if f in analytics.columns]
    ranked = F.col("efectos")
    effects = e.effect_table(residual, "log_dur", "residuo", factors).agg(
        F.array_sort(
            F.collect_list(F.struct("factor", "eta2_marginal", "eta2_parcial")),
            lambda a, b: F.when(a["eta2_parcial"] > b["eta2_parcial"], -1)
            .when(a["eta2_parcial"] < b["eta2_parcial"], 1).otherwise(F.when(a["factor"] < b["factor"], -1).otherwise(1)),
        ).alias("efectos"))
    fit = e.one_row(e.simple_regression(logs, "log_dist", "log_dur"))
    shape = e.one_row(e.distribution_shape(analytics, "trip_duration", scale=1.0))
    return (
        analytics.agg(F.count(F.lit(1)).alias("n_viajes"))
        .withColumns({"_fit": fit, "_shape": shape, "efectos": effects.scalar()})
        .select(
            F.current_timestamp().alias("generado_en"),
            F.lit(source).alias("tabla_origen"),
            "n_viajes",
            F.struct(
                F.col("_shape.mediana_min").cast("double").alias("mediana_seg"),
                F.col("_shape.media_min").alias("media_seg"),
                "_shape.asimetria", "_shape.asimetria_log",
            ).alias("target"),
            F.round("_fit.r2", 6).alias("r2_distancia_sola"),
            F.struct(*[F.round(f"_fit.{c}", 6).alias(c) for c in ("intercepto", "pendiente", "r2")])
            .alias("ajuste_distancia"),
            ranked,
            F.transform("efectos", lambda x: x["factor"]).alias("orden_esperado_importancia"),
        )
    )


def run_eda(spark: SparkSession, tables: TableNames = TABLES, summary_path: str | None = None) -> dict[str, DataFrame]:
    """Report frames from the product tables; the summary goes to JSON when a path is given."""
    analytics = spark.table(tables.analytics)
    frames = eda_frames(analytics, spark.table(tables.demand))
    frames["resumen"] = eda_summary(analytics, tables.analytics)
    if summary_path:
        write_summary_json(frames["resumen"], summary_path)
    return frames
