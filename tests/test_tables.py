"""Sources, sinks, quality, incremental batches and the pipelines through tables."""

import pytest
from pyspark.sql import functions as F

from tripstrata.config import RAW_COLUMNS, RULE_NAMES, THRESHOLDS, TableNames
from tripstrata.functions.typing import apply_types, schema_report
from tripstrata.operators import alerts, quality
from tripstrata.plans import bronze, gold, monitoring, silver
from tripstrata.sources import audit, readers, staging, writers
from tripstrata.sources.event_trips import raw_trips
from tripstrata.streaming.incremental import incremental_batch, replace_days

GOOD = ("id1", "1", "2016-01-15 08:30:00", "2016-01-15 08:40:00", "2", "-73.98", "40.76", "-73.96", "40.75", "N", "600")


def raw(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def changed(**values):
    return tuple(values.get(c, v) for c, v in zip(RAW_COLUMNS, GOOD))


def test_undecided_rules_end_in_quarantine(spark):
    rows = raw(spark, GOOD, changed(id="id2", pickup_latitude=None), changed(id="id3", passenger_count=None),
               changed(id=None), changed(id="id5", trip_duration=None), changed(id="id6", dropoff_longitude="0", dropoff_latitude="0"))
    flagged = quality.flag_rules(apply_types(rows))
    good, bad = quality.quarantine_split(flagged)
    assert [r.id for r in good.collect()] == ["id1"] and bad.count() == 5
    assert not set(good.columns) & {*RULE_NAMES, "es_valido"}
    summary = quality.dq_summary(flagged).first()
    assert (summary.total_filas, summary.total_invalidas, summary.v_completitud, summary.v_coords_pickup) == (6, 5, 2, 1)
    quality.assert_conserved(quality.conservation_check(flagged, {"a": good, "b": bad}, good, ["id"]), ["a", "b"])


def test_lost_casts_are_reported(spark):
    rows = raw(spark, GOOD, changed(id="id2", trip_duration="12.x"), changed(id="id3", pickup_datetime="not a time"))
    losses = quality.cast_losses(rows, list(RAW_COLUMNS), apply_types)
    assert {r.columna: r.valores_perdidos for r in losses.collect() if r.valores_perdidos} == {
        "trip_duration": 1, "pickup_datetime": 1}
    with pytest.raises(ValueError, match="trip_duration"):
        quality.assert_no_cast_losses(losses)


def test_scoring_file_is_typed_without_the_target(spark):
    rows = raw(spark, GOOD).drop("dropoff_datetime", "trip_duration")
    kinds = {r.columna: r.tipo for r in schema_report(apply_types(rows)).collect()}
    assert kinds["pickup_datetime"] == "timestamp" and kinds["passenger_count"] == "int" and "trip_duration" not in kinds


def test_hash_tells_null_from_empty_and_ignores_audit(spark):
    rows = raw(spark, GOOD, changed(vendor_id=None), changed(vendor_id=""))
    hashes = [r[0] for r in rows.select(audit.row_hash(list(RAW_COLUMNS))).collect()]
    assert len(set(hashes)) == 3
    again = bronze.bronze_frame(raw(spark, GOOD), "other.csv", "scoring").first()
    assert again._row_hash == hashes[0] and again._origen == "scoring"


def test_dedup_keeps_one_of_a_third_of_copies(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("id"))
    df = rows.withColumn("_row_hash", audit.row_hash(["id"])).repartition(6)
    kept = quality.dedup_exact(df)
    assert kept.count() == kept.select("id").distinct().count() == 601
    check = audit.load_check(df, expected=900).first()
    assert (check.n_filas, check.n_hash, check.n_ids, check.duplicados_exactos, check.conteo_correcto) == (900, 601, 601, 299, True)
    with pytest.raises(ValueError, match="901 expected"):
        audit.assert_loaded(audit.load_check(df, expected=901))


def test_csv_with_another_layout_fails(spark, tmp_path):
    path = str(tmp_path / "short.csv")
    (tmp_path / "short.csv").write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(GOOD[:4]) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|header"):
        readers.read_raw_csv(spark, path, list(RAW_COLUMNS)).collect()
    (tmp_path / "swapped.csv").write_text(",".join(reversed(RAW_COLUMNS)) + "\n" + ",".join(GOOD) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|header"):
        readers.read_raw_csv(spark, str(tmp_path / "swapped.csv"), list(RAW_COLUMNS)).collect()


def test_missing_summary_is_none(spark, tmp_path):
    assert readers.stats_from_summary(spark, str(tmp_path / "none")) is None
    writers.write_summary_json(spark.range(1).select(F.struct(F.lit(2.5).alias("mae_min")).alias("metricas_test")), str(tmp_path / "s"))
    assert readers.stats_from_summary(spark, str(tmp_path / "s")).first().metricas_test.mae_min == 2.5


def test_stage_round_trip(spark):
    df = spark.range(100).withColumn("p", F.col("id") % 2 == 0)
    staged = staging.stage_table(df, "t", partition_by="p")
    assert staged.filter("p").count() == 50 and staged.schema["p"].dataType == df.schema["p"].dataType
    assert "PartitionFilters: [isnotnull(p" in explained(staged.filter("p").select("id"))
    staging.drop_stage(staged)
    with pytest.raises(Exception, match="(?i)not exist"):
        staged.collect()


def explained(df):
    return df._jdf.queryExecution().toString()


def test_replaying_a_batch_changes_nothing(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    path = str(tmp_path / "days")
    for day in ("2024-01-08", "2024-01-15", "2024-01-08"):
        stored = replace_days(incremental_batch(events, day, "ts"), path)
    want = events.filter("ts >= '2024-01-01' AND ts < '2024-01-15'").count()
    assert stored.count() == stored.select("event_id").distinct().count() == want
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in explained(incremental_batch(events, "2024-01-08", "ts"))


def test_alerts(spark):
    ref = spark.createDataFrame([("a",)] * 90 + [("b",)] * 10, "z string")
    lost = alerts.coverage_loss(ref, ref.filter("z = 'a'"), ["z"])
    assert [(r.categoria, r.peso) for r in lost.collect()] == [("b", 0.1)]
    table = alerts.alert_table(
        alerts.coverage_alert(lost),
        alerts.quarantine_alert(spark.createDataFrame([(7, 1000)], "total_invalidas long, total_filas long")),
        alerts.covariate_alert(spark.createDataFrame([(0.14,)], "psi double")),
        alerts.error_alerts(spark.createDataFrame([(1.2, 1.0)], "mae_min double, mae_referencia double")),
        alerts.missing_batch_alert(spark.createDataFrame([("2016-01-01",)], "d string"), "d", "2016-02-01"))
    assert {r.disparador: r.activa for r in table.collect()} == {
        "Cobertura perdida": True, "Calidad degradada": True, "Deriva de covariables": False,
        "Degradacion del error": True, "Degradacion severa": False, "Ausencia de lote": True}
    history = spark.createDataFrame(
        [(1, "Alta", True), (2, "Media", True), (3, "Alta", True), (4, "Critica", True), (4, "Media", True), (5, "Alta", False)],
        "evaluado_en int, severidad string, activa boolean")
    assert [r.reentrenar for r in alerts.retrain_trigger(history).orderBy("evaluado_en").collect()] == [False, False, False, True, False]


@pytest.fixture(scope="module")
def layers(spark, sf, tmp_path_factory):
    from dataclasses import replace

    names = TableNames(bronze="t_bronze", silver="t_silver", gold="t_gold")
    folder = str(tmp_path_factory.mktemp("landing") / "train.csv")
    raw_trips(spark, sf).write.option("header", "true").csv(folder)
    limits = replace(THRESHOLDS, split_cutoff="2024-01-24", zones=5)
    check = bronze.run_bronze(spark, folder, expected=1000, tables=names)
    first = silver.run_silver(spark, names, limits)
    return names, check, first, gold.run_gold(spark, names, limits)


def test_layers_conserve_rows(spark, layers):
    names, check, frames, products = layers
    assert check["n_filas"] == 1000 and check["duplicados_exactos"] == 0
    clean, bad = spark.table(names.clean).count(), spark.table(names.quarantine).count()
    assert clean + bad == 1000 and frames.summary.first().total_invalidas == bad
    assert products.features.count() == products.analytics.count() == clean
    assert products.demand.agg(F.sum("n_viajes")).first()[0] == clean
    assert len(products.centroids) == 5
    assert spark.table(names.dq_metrics).count() == 5


def test_histories_grow_and_tables_are_replaced(spark, layers):
    names, *_ = layers
    silver.run_silver(spark, names, THRESHOLDS)
    assert spark.table(names.dq_metrics).count() == 10
    assert spark.table(names.clean).count() + spark.table(names.quarantine).count() == 1000


def test_reading_one_split_prunes_the_other(spark, layers):
    names, *_ = layers
    plan = explained(spark.table(names.features).filter("split_flag = 'train'").select("pickup_hour"))
    assert "PartitionFilters: [isnotnull(split_flag" in plan
    assert "ReadSchema: struct<pickup_hour:int>" in plan


def test_monitoring_appends_its_history(spark, layers):
    names, *_ = layers
    frames = monitoring.run_monitoring(spark, names, columns=["distancia_haversine_km", "pickup_hour"], intensities=(0.0, 1.0))
    rows = frames["historial"].collect()
    assert {r.variable for r in rows} == {"distancia_haversine_km", "pickup_hour", "objetivo_duracion"}
    assert frames["intensidad_minima"].count() == 3
