"""Alert rules over quality, drift, coverage and error, and the retraining trigger."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import THRESHOLDS, Thresholds

# Severities in rising order.
MEDIUM, HIGH, CRITICAL = "Media", "Alta", "Critica"


def degradation_level(mae: Column, reference: Column, t: Thresholds = THRESHOLDS) -> Column:
    """critico, atencion or normal, relative to the error measured when the model was accepted."""
    return (
        F.when(mae > reference * t.mae_critical, "critico")
        .when(mae > reference * t.mae_attention, "atencion")
        .when(mae.isNotNull() & reference.isNotNull(), "normal")
    )


def degradation_limits(reference: DataFrame, mae: str = "mae_min", t: Thresholds = THRESHOLDS) -> DataFrame:
    """Reference error with the limits derived from it."""
    return reference.select(
        F.col(mae).alias("mae_referencia"),
        (F.col(mae) * t.mae_attention).alias("limite_atencion"),
        (F.col(mae) * t.mae_critical).alias("limite_critico"),
    )


def coverage_loss(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
                  weight: float = THRESHOLDS.coverage_weight) -> DataFrame:
    """Categories above ``weight`` in the reference that no row of the batch has.

    Both sides are reduced to one row per category before they meet.
    """
    def categories(df):
        return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
            [], list(columns), "variable", "categoria").filter("categoria IS NOT NULL")

    counts = categories(reference).groupBy("variable", "categoria").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("total"))
    # One row per named variable.
    heavy = counts.join(F.broadcast(totals), "variable").select(
        "variable", "categoria", (F.col("n") / F.col("total")).alias("peso")).filter(F.col("peso") > weight)
    seen = categories(batch).groupBy("variable", "categoria").agg(F.lit(1).alias("_seen")).drop("_seen")
    return heavy.join(seen, ["variable", "categoria"], "left_anti")


def _alert(source: DataFrame, trigger: str, severity: str, value: Column, limit: float | Column) -> DataFrame:
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    return source.agg(value.cast("double").alias("valor"), limit.cast("double").alias("umbral")).select(
        F.lit(trigger).alias("disparador"),
        F.lit(severity).alias("severidad"),
        "valor", "umbral",
        F.coalesce(F.col("valor") > F.col("umbral"), F.lit(False)).alias("activa"),
    )


def quarantine_alert(summary: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    """Share of rejected rows against three times the usual one."""
    pct = F.max(F.col("total_invalidas") / F.nullif("total_filas", F.lit(0)) * 100)
    return _alert(summary, "Calidad degradada", HIGH, pct, t.usual_quarantine_pct * t.quarantine_factor)


def covariate_alert(psi: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    return _alert(psi, "Deriva de covariables", MEDIUM, F.max("psi"), t.proposed_psi_alert)


def coverage_alert(lost: DataFrame) -> DataFrame:
    return _alert(lost, "Cobertura perdida", MEDIUM, F.count(F.lit(1)), 0)


def target_alert(target_psi: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    return _alert(target_psi, "Deriva del objetivo", HIGH, F.max("psi"), t.proposed_psi_alert)


def error_alerts(errors: DataFrame, mae: str = "mae_min", reference: str = "mae_referencia",
                 t: Thresholds = THRESHOLDS) -> DataFrame:
    """Error of a labelled batch against the reference error: one row per severity."""
    attention = _alert(errors, "Degradacion del error", HIGH, F.max(mae), F.max(reference) * t.mae_attention)
    critical = _alert(errors, "Degradacion severa", CRITICAL, F.max(mae), F.max(reference) * t.mae_critical)
    return attention.unionByName(critical)


def missing_batch_alert(batch: DataFrame, ts: str, expected_from: str) -> DataFrame:
    """Alarms when no row of the batch is dated ``expected_from`` or later. The value is 1 when missing."""
    missing = F.when(F.count_if(F.to_date(ts) >= F.lit(expected_from).cast("date")) == 0, 1).otherwise(0)
    return _alert(batch, "Ausencia de lote", MEDIUM, missing, 0)


def failed_load_alert(check: DataFrame) -> DataFrame:
    """Alarms when a load check did not find the expected rows."""
    return _alert(check, "Fallo de carga", CRITICAL, F.count_if(~F.col("conteo_correcto")), 0)


def alert_table(*alerts: DataFrame) -> DataFrame:
    """All checks of one evaluation, one row each."""
    return reduce(DataFrame.unionByName, alerts)


def retrain_trigger(history: DataFrame, when: str = "evaluado_en", severity: str = "severidad",
                    active: str = "activa") -> DataFrame:
    """Evaluations at which retraining is due: a high severity now and in the evaluation before.

    Reduced to one row per evaluation before it is ordered (weekly batches: 52 rows a year).
    """
    high = F.col(active) & F.col(severity).isin(HIGH, CRITICAL)
    per_run = history.groupBy(when).agg(F.max(F.coalesce(high, F.lit(False))).alias("alta"))
    before = F.lag("alta", 1, False).over(W.orderBy(when))
    return per_run.withColumn("reentrenar", F.col("alta") & before)
