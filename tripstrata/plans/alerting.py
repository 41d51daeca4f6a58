"""The alert stage: all triggers of one evaluation, their history, and whether retraining is due."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import MODEL, TABLES, THRESHOLDS, TableNames, Thresholds
from tripstrata.operators import alerts as a
from tripstrata.operators import drift as d
from tripstrata.sources.writers import append_history


def batch_error(reference: DataFrame, batch: DataFrame, pred: str, real: str = MODEL.target) -> DataFrame:
    """Mean absolute error in minutes of the batch (``mae_min``) next to the reference's (``mae_referencia``)."""
    error = F.avg(F.abs(F.col(pred) - F.col(real))) / 60
    return batch.agg(error.alias("mae_min")).withColumn("mae_referencia", reference.agg(error.alias("m")).scalar())


def run_alerts(spark: SparkSession, reference: DataFrame, batch: DataFrame, quality: DataFrame, load: DataFrame,
               expected_from: str, pred: str, tables: TableNames = TABLES, t: Thresholds = THRESHOLDS,
               ts: str = "pickup_datetime", columns=MODEL.monitored) -> dict[str, DataFrame]:
    """Evaluate the eight triggers and append them to the alert history.

    ``quality`` is the quality summary and ``load`` the load check of the batch; ``reference`` and ``batch`` are scored
    rows with their time. Returns this evaluation's table, the error level of the batch, and per
    evaluation of the history whether retraining is due.
    """
    errors = batch_error(reference, batch, pred)
    found = a.alert_table(
        a.quarantine_alert(quality, t),
        a.covariate_alert(d.psi_by_variable(reference, batch, columns), t),
        a.target_alert(d.target_drift(reference, batch, MODEL.target), t),
        a.coverage_alert(a.coverage_loss(reference, batch, ["pickup_cluster", "pickup_hour"])),
        a.error_alerts(errors, t=t),
        a.missing_batch_alert(batch, ts, expected_from),
        a.failed_load_alert(load),
    ).withColumn("evaluado_en", F.current_timestamp())
    history = append_history(found, tables.alerts)
    latest = history.agg(F.max("evaluado_en")).scalar()
    level = errors.withColumn("nivel", a.degradation_level(F.col("mae_min"), F.col("mae_referencia"), t))
    return {"alertas": history.filter(F.col("evaluado_en") == latest), "nivel": level, "historial": history,
            "reentrenar": a.retrain_trigger(history)}
