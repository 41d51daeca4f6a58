"""Modelling: baselines, ridge, boosted trees, forward search, evaluation and residuals."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import MODEL, TABLES, TEST, THRESHOLDS, TRAIN, TableNames, Thresholds
from tripstrata.functions.calendar import forward_windows
from tripstrata.functions.numeric import clip
from tripstrata.operators import baselines as b
from tripstrata.operators import evaluation as ev
from tripstrata.operators import models as m
from tripstrata.operators.boosting import BoostedTrees
from tripstrata.operators.ordering import positions, rank_agreement, rank_compare
from tripstrata.sources.readers import stats_from_summary
from tripstrata.sources.staging import stage_table
from tripstrata.sources.writers import append_history, write_summary_json

# Names of the compared models.
CALENDAR, DISTANCE_HOUR = "Baseline calendario", "Baseline distancia x hora"
RIDGE, GBT, TUNED = "Regresion lineal (recortada)", "GBT por defecto", "GBT ajustado"


def baseline_predictions(train: DataFrame, df: DataFrame) -> DataFrame:
    """Both group-median predictions, held to the valid range."""
    scored = b.calendar_baseline(train, df, "p_calendario")
    scored = b.distance_hour_baseline(train, scored, "p_distancia_hora")
    return scored.withColumns({c: clip(F.col(c)) for c in ("p_calendario", "p_distancia_hora")})


def expected_order(summary: DataFrame) -> DataFrame:
    """Factors with their 1-based position in the earlier effect ranking."""
    return summary.select(F.posexplode("orden_esperado_importancia").alias("_p", "factor")).select(
        "factor", (F.col("_p") + 1).alias("pos"))


def run_model(spark: SparkSession, tables: TableNames = TABLES, first_day: str = "2016-01-01",
              t: Thresholds = THRESHOLDS, grid: Sequence[m.BoostingParams] = m.GRID, windows: int = 3,
              eda_path: str | None = None, summary_path: str | None = None,
              model_path: str | None = None) -> dict[str, DataFrame]:
    """Fit and compare all models on the features table; append the run history.

    The test split takes no part in the search. Scored rows are staged once, since every
    metric and residual table reads them. With ``model_path`` the tuned trees and the ridge model are written
    below it, for :func:`score_batch`.
    """
    target = MODEL.target
    features = spark.table(tables.features)
    train, test = features.filter(F.col("split_flag") == TRAIN), features.filter(F.col("split_flag") == TEST)

    # The analytics table holds the same rows with their time, so no join by id is needed.
    timed = spark.table(tables.analytics).filter(F.col("split_flag") == TRAIN)
    dated = timed.withColumns({"fecha": F.to_date("pickup_datetime"), MODEL.target_log: F.log1p(target)})
    # Passes of the trees are small jobs that mostly wait, so fits that do not need each other run side by side.
    with ThreadPoolExecutor(2) as pool:
        fits = [pool.submit(inheritable_thread_target(fit), *given) for fit, given in ((m.fit_gbt, (train, grid[0])), (m.fit_ridge, (train,)))]
        best, search = m.forward_search(dated, forward_windows(first_day, t.split_cutoff, windows), grid)
        default, ridge = (fit.result() for fit in fits)
    if best == grid[0]:  # the same fit on the same rows
        tuned, scored = default, m.predict(default, train.unionByName(test))
    else:
        tuned, scored = m.final_fit_predict(train, test, best)

    if model_path:
        tuned.save(spark, f"{model_path}/ajustado")
        ridge.write().overwrite().save(f"{model_path}/lineal")

    scored = baseline_predictions(train, scored.withColumnRenamed("pred", "p_ajustado"))
    scored = m.predict(ridge, scored, "p_lineal_libre", clipped=False)
    scored = scored.withColumn("p_lineal", clip(F.col("p_lineal_libre")))
    scored = stage_table(m.predict(default, scored, "p_defecto"), "scored")
    on_test = scored.filter(F.col("split_flag") == TEST)

    names = {CALENDAR: "p_calendario", DISTANCE_HOUR: "p_distancia_hora", RIDGE: "p_lineal", GBT: "p_defecto",
             TUNED: "p_ajustado"}
    metrics = stage_table(
        ev.regression_metrics(ev.predictions_long(on_test, target, names), target, "pred"), "metrics")
    by_split = ev.regression_metrics(scored, target, "p_ajustado", by=["split_flag"])
    residuals = ev.with_residual_minutes(on_test, target, "p_ajustado")
    importance = stage_table(m.permutation_importance(tuned, on_test), "importance")
    reading = ev.business_reading(on_test, target, "p_ajustado")

    params = {RIDGE: {"modelo": "ridge", "alpha": 1.0}, GBT: vars(grid[0]), TUNED: vars(best),
              CALENDAR: {"tipo": "mediana por hora y dia"}, DISTANCE_HOUR: {"tipo": "mediana por tramo y hora"}}
    append_history(m.run_log(metrics, params), tables.model_runs)

    frames = {
        "metricas": metrics,
        "comparacion": ev.model_comparison(metrics, [CALENDAR, DISTANCE_HOUR]),
        "busqueda": search,
        "sobreajuste": ev.overfit_gap(by_split),
        "lectura": reading,
        "limite": ev.over_limit_report(on_test, target, "p_lineal_libre"),
        "residuos": ev.residual_summary(residuals),
        "residuos_segmento": ev.residual_by_segment(residuals, ["pickup_hour", "es_aeropuerto"]),
        "residuos_tramo": ev.residual_by_band(residuals),
        "cola": ev.tail_contribution(residuals, target),
        "importancia": importance,
    }
    frames["resumen"] = model_summary(frames, by_split, best, features)
    expected = stats_from_summary(spark, eda_path) if eda_path else None
    if expected is not None:
        obtained = positions(importance.withColumnRenamed("variable", "factor"), "factor", "importancia")
        frames["contraste"] = rank_compare(expected_order(expected), obtained)
        frames["concordancia"] = rank_agreement(frames["contraste"])
    if summary_path:
        write_summary_json(frames["resumen"], summary_path)
    return frames


def score_batch(df: DataFrame, model_path: str, name: str = "ajustado", output: str = "pred") -> DataFrame:
    """Later rows scored by a model that :func:`run_model` wrote."""
    path = f"{model_path}/{name}"
    model = PipelineModel.load(path) if name == "lineal" else BoostedTrees.load(df.sparkSession, path)
    return m.predict(model, df, output)


def model_summary(frames: dict[str, DataFrame], by_split: DataFrame, best: m.BoostingParams,
                  features: DataFrame) -> DataFrame:
    """One row with what later steps need: parameters, metrics, reading, comparison and importances."""
    def listed(df):
        return df.agg(F.collect_list(F.struct("*"))).scalar()

    names = ("rmse_min", "mae_min", "r2", "rmsle")

    def of(split):
        side = by_split.filter(F.col("split_flag") == split)
        return side.select(F.struct(*[F.round(n, 6).alias(n) for n in names])).scalar()

    return features.agg(
        F.count_if(F.col("split_flag") == TRAIN).alias("n_train"),
        F.count_if(F.col("split_flag") == TEST).alias("n_test"),
    ).withColumns({
        "modelo": F.lit("HistogramBoosting"),
        "hiperparametros": F.struct(*[F.lit(v).alias(k) for k, v in vars(best).items() if v is not None]),
        "recorte_prediccion": F.array(F.lit(THRESHOLDS.duration_min_s), F.lit(THRESHOLDS.duration_max_s)),
        "metricas_test": of(TEST),
        "metricas_train": of(TRAIN),
        "lectura_negocio": frames["lectura"].select(F.struct("*")).scalar(),
        "comparacion": listed(frames["metricas"]),
        "importancias": listed(frames["importancia"].select("variable", "importancia")),
        "busqueda_hiperparametros": listed(frames["busqueda"]),
    })
