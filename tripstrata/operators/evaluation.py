"""Regression metrics, their business reading, overfitting and residual analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import RESIDUAL_CUTS, THRESHOLDS
from tripstrata.functions.numeric import band_label, bucket_right_closed
from tripstrata.operators.effects import one_row
from tripstrata.operators.quantiles import quantiles


def _log1p_floor(value: Column) -> Column:
    return F.log1p(F.greatest(value.cast("double"), F.lit(0.0)))


def regression_metrics(scored: DataFrame, real: str, pred: str, by: Sequence[str] = ("modelo",)) -> DataFrame:
    """RMSE and MAE in minutes, R² and RMSLE per model, in one pass. R² is 0 when the target does not vary."""
    error = F.col(pred) - F.col(real)
    log_error = _log1p_floor(F.col(pred)) - _log1p_floor(F.col(real))
    mean_square = F.avg(error * error)
    return scored.groupBy(*by).agg(
        (F.sqrt(mean_square) / 60).alias("rmse_min"),
        (F.avg(F.abs(error)) / 60).alias("mae_min"),
        F.when(F.var_pop(real) != 0, 1 - mean_square / F.var_pop(real)).otherwise(F.lit(0.0)).alias("r2"),
        F.sqrt(F.avg(log_error * log_error)).alias("rmsle"),
    )


def predictions_long(df: DataFrame, real: str, models: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per row and model from one prediction column per model; ``models`` maps names to columns."""
    columns = [F.col(column).cast("double").alias(name) for name, column in models.items()]
    return df.select(*keep, real, *columns).unpivot([*keep, real], list(models), "modelo", "pred")


def business_reading(scored: DataFrame, real: str, pred: str, domain: str = "continuous") -> DataFrame:
    """The error in minutes next to the median trip, as a share of it and as a window around it."""
    middle = one_row(quantiles(scored, [], real, [0.5], ["mediana"], domain))
    return reading_columns(
        scored.agg(F.avg(F.abs(F.col(pred) - F.col(real))).alias("_mae"))
        .withColumn("_mediana", middle["mediana"]), "_mae", "_mediana"
    )


def reading_columns(df: DataFrame, mae_seconds: str, median_seconds: str) -> DataFrame:
    """:func:`business_reading` from a mean absolute error and a median, both in seconds."""
    error, middle = F.col(mae_seconds) / 60, F.col(median_seconds) / 60
    share = F.when(F.col(median_seconds) != 0, F.col(mae_seconds) / F.col(median_seconds)).otherwise(F.lit(0.0))
    return df.select(
        F.round(error, 2).alias("error_medio_min"),
        F.round(middle, 2).alias("viaje_mediano_min"),
        F.round(share * 100, 1).alias("error_relativo_pct"),
        F.round(F.greatest(F.lit(0.0), middle - error), 1).alias("ventana_min"),
        F.round(middle + error, 1).alias("ventana_max"),
    )


def overfit_gap(metrics: DataFrame, split: str = "split_flag", names: Sequence[str] = ("rmse_min", "mae_min", "rmsle"),
                train: str = "train", test: str = "test") -> DataFrame:
    """Gap between the test and the training value of each metric, absolute and relative."""
    def on(side, name):
        return F.max(F.when(F.col(split) == side, F.col(name)))

    wide = metrics.agg(*[
        F.struct(on(train, m).alias("train"), on(test, m).alias("test")).alias(m) for m in names
    ])
    gap = F.col("v.test") - F.col("v.train")
    return wide.unpivot([], list(names), "metrica", "v").select(
        "metrica",
        F.round("v.train", 4).alias("train"),
        F.round("v.test", 4).alias("test"),
        F.round(gap, 4).alias("brecha_absoluta"),
        F.round(F.when(F.col("v.train") != 0, gap / F.col("v.train") * 100).otherwise(F.lit(0.0)), 1)
        .alias("brecha_relativa_pct"),
    )


def model_comparison(metrics: DataFrame, baselines: Sequence[str], metric: str = "rmsle") -> DataFrame:
    """Every model with its improvement over the best baseline, in percent."""
    # One row per model.
    best = F.min(F.when(F.col("modelo").isin(list(baselines)), F.col(metric))).over(W.partitionBy())
    return metrics.withColumn("mejora_pct", (1 - F.col(metric) / best) * 100)


def with_residual_minutes(scored: DataFrame, real: str, pred: str, output: str = "residuo_min") -> DataFrame:
    """Prediction less real value, in minutes: negative where a trip was under-predicted."""
    return scored.withColumn(output, (F.col(pred) - F.col(real)) / 60)


def residual_summary(residuals: DataFrame, residual: str = "residuo_min") -> DataFrame:
    """Count, mean, median, sample deviation and bias-corrected skewness."""
    n = F.count(residual)
    corrected = F.skewness(residual) * F.sqrt((n * (n - 1)).cast("double")) / F.nullif(n - 2, F.lit(0))
    middle = one_row(quantiles(residuals, [], residual, [0.5], ["mediana"]))
    return residuals.agg(
        n.alias("n"),
        F.avg(residual).alias("media"),
        F.stddev_samp(residual).alias("desv_est"),
        F.when(n > 2, corrected).alias("asimetria"),
    ).withColumn("mediana", middle["mediana"])


def residual_by_segment(residuals: DataFrame, segments: Sequence[str], residual: str = "residuo_min") -> DataFrame:
    """Median residual within every level of every segment column, all segments in one search."""
    long = residuals.select(*[F.col(s).cast("string").alias(s) for s in segments], residual).unpivot(
        [residual], list(segments), "segmento", "nivel")
    return quantiles(long, ["segmento", "nivel"], residual, [0.5], ["residuo_mediano"])


def residual_by_band(residuals: DataFrame, distance: str = "distancia_haversine_km", residual: str = "residuo_min",
                     cuts: Sequence[float] = RESIDUAL_CUTS, more_than: int = 50) -> DataFrame:
    """Per distance band: rows, median absolute error and median residual; thin bands are left out."""
    banded = residuals.withColumn("_band", bucket_right_closed(F.col(distance), cuts, open_end=False)).filter(
        "_band IS NOT NULL")
    long = banded.select("_band", F.col(residual).alias("sesgo"), F.abs(residual).alias("error_abs")).unpivot(
        ["_band"], ["sesgo", "error_abs"], "medida", "valor")
    found = quantiles(long, ["_band", "medida"], "valor", [0.5], ["mediana"])
    return (
        found.groupBy("_band").agg(
            F.max("n").alias("n"),
            F.max(F.when(F.col("medida") == "error_abs", F.col("mediana"))).alias("error_abs_mediano"),
            F.max(F.when(F.col("medida") == "sesgo", F.col("mediana"))).alias("sesgo_mediano"),
        )
        .filter(F.col("n") > more_than)
        .select(band_label(F.col("_band"), cuts).alias("tramo"), "n", "error_abs_mediano", "sesgo_mediano")
    )


def tail_contribution(residuals: DataFrame, real: str, residual: str = "residuo_min",
                      minutes: float = THRESHOLDS.tail_minutes, domain: str = "continuous") -> DataFrame:
    """How much of the squared error comes from trips under-predicted by more than ``minutes``."""
    in_tail = F.col(residual) < -minutes
    square = F.col(residual) * F.col(residual)
    sides = residuals.filter(F.col(residual).isNotNull()).select(
        F.when(in_tail, "cola").otherwise("resto").alias("lado"), real)
    medians = one_row(
        quantiles(sides, ["lado"], real, [0.5], ["mediana"], domain).agg(
            F.max(F.when(F.col("lado") == "cola", F.col("mediana"))).alias("cola"),
            F.max(F.when(F.col("lado") == "resto", F.col("mediana"))).alias("resto"),
        )
    )
    return residuals.agg(
        F.count_if(in_tail).alias("n_cola"),
        (F.avg(in_tail.cast("double")) * 100).alias("pct_cola"),
        (F.sum(F.when(in_tail, square).otherwise(F.lit(0.0))) / F.nullif(F.sum(square), F.lit(0.0)) * 100)
        .alias("pct_error_cuadratico"),
    ).withColumn("_m", medians).select(
        "n_cola", "pct_cola", "pct_error_cuadratico",
        (F.col("_m.cola") / 60.0).alias("real_mediana_cola_min"),
        (F.col("_m.resto") / 60.0).alias("real_mediana_resto_min"),
    )


def over_limit_report(scored: DataFrame, real: str, pred: str, limit: float = THRESHOLDS.duration_max_s) -> DataFrame:
    """Largest prediction, how many exceed the valid limit, and the largest real value."""
    return scored.agg(
        (F.max(pred) / 3600.0).alias("pred_max_horas"),
        F.count_if(F.col(pred) > limit).alias("n_sobre_limite"),
        (F.max(real) / 3600.0).alias("real_max_horas"),
    )
