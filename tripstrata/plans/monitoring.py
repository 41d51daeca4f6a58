"""Monitoring: a batch against the training reference, sensitivity, error limits and alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import INTENSITIES, MODEL, TABLES, TEST, TRAIN, TableNames
from tripstrata.operators import alerts as a
from tripstrata.operators import drift as d
from tripstrata.operators import profile as pf
from tripstrata.operators import scenarios as s
from tripstrata.sources.readers import stats_from_summary
from tripstrata.sources.staging import stage_table
from tripstrata.sources.writers import append_history
from tripstrata.streaming.incremental import write_partitions


def monitoring_frames(reference: DataFrame, batch: DataFrame, columns: Sequence[str] = MODEL.monitored,
                      target: str = MODEL.target, intensities: Sequence[float] = INTENSITIES) -> dict[str, DataFrame]:
    """Drift of features and target, lost coverage and the sensitivity of the detector.

    Each result is a few rows that several frames below read, so it is staged.
    """
    psi = stage_table(d.psi_by_variable(reference, batch, columns), "psi")
    target_psi = stage_table(d.target_drift(reference, batch, target), "target_psi")
    sweep = stage_table(s.sensitivity_sweep(reference, batch, columns, intensities), "sweep")
    lost = stage_table(a.coverage_loss(reference, batch, ["pickup_cluster", "pickup_hour"]), "coverage")
    return {
        "psi": psi,
        "deriva": d.with_batch_alert(psi),
        "deriva_objetivo": target_psi,
        "barrido": sweep,
        "intensidad_minima": s.min_detected_intensity(sweep),
        "cobertura": lost,
        "alertas": a.alert_table(a.covariate_alert(psi), a.coverage_alert(lost), a.target_alert(target_psi)),
    }


def run_monitoring(spark: SparkSession, tables: TableNames = TABLES, batch_name: str = "particion de evaluacion",
                   model_path: str | None = None, columns: Sequence[str] = MODEL.monitored,
                   intensities: Sequence[float] = INTENSITIES) -> dict[str, DataFrame]:
    """Compare the later split with the training split, append the history, and add error
    limits when a model summary exists. Partition pruning reads each split once."""
    features = spark.table(tables.features)
    reference, batch = features.filter(F.col("split_flag") == TRAIN), features.filter(F.col("split_flag") == TEST)
    frames = monitoring_frames(reference, batch, columns, intensities=intensities)
    summary = stats_from_summary(spark, model_path) if model_path else None
    if summary is not None:
        frames["limites_error"] = a.degradation_limits(summary.select(F.col("metricas_test.mae_min").alias("mae_min")))
    history = d.drift_history(frames["deriva"], frames["deriva_objetivo"], batch_name)
    frames["historial"] = append_history(history, tables.drift)
    return frames


def monitor_batch(batch: DataFrame, profile_path: str, reference: Callable[[], DataFrame], columns: Sequence[str] = MODEL.monitored,
                  target: str = MODEL.target, tag: str = "", counts_path: str | None = None, name: str = "") -> dict[str, DataFrame]:
    """Drift of a week against the kept profile of the reference, which is built only where none of its version is stored.

    With ``counts_path`` the week's counts are kept there under ``name``, replacing those of an earlier run, and ``acumulado`` is
    the drift of all weeks kept so far, from their counts alone.
    """
    spark = batch.sparkSession
    profile = pf.kept_profile(spark, profile_path, reference, [*columns, target], tag=tag)
    counts = stage_table(pf.batch_counts(profile, batch), "counts")
    psi = stage_table(pf.psi_from_profile(profile, counts), "psi")
    frames = {"deriva": d.with_batch_alert(psi.filter(F.col("variable") != target)),
              "deriva_objetivo": psi.filter(F.col("variable") == target).withColumn("estado", d.classify_psi(F.col("psi")))}
    if counts_path:
        write_partitions(counts.withColumn("lote", F.lit(name)), counts_path, ["lote"])
        kept = spark.read.schema("variable string, version string, bin int, n long, lote string").parquet(counts_path)
        same = kept.join(profile.select("version").distinct(), "version", "left_semi")
        whole = pf.psi_from_profile(profile, pf.merge_counts(same))
        frames["acumulado"] = d.with_batch_alert(whole.filter(F.col("variable") != target))
    return frames
