"""Fitted models: known solutions, baselines beaten, importance of what matters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstrata.config import MODEL, ModelColumns
from tripstrata.functions.calendar import forward_windows
from tripstrata.operators import baselines, models, zones
from tripstrata.operators.evaluation import regression_metrics

SMALL = ModelColumns(whitelist=("x", "z", "k"), numeric=("x", "z"), categorical=("k",), target="y", target_log="y_log")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(3)
    rows = []
    for i in range(1500):
        x, z, k = rng.rand() * 10, rng.rand(), rng.randint(4)
        y = float(np.expm1(4 + 0.3 * x + 0.5 * (k == 2) + 0.05 * rng.randn()))
        rows.append((f"id{i}", float(x), float(z), f"k{k}", y, float(np.log1p(y)), f"2024-01-{1 + i % 28:02d}"))
    return spark.createDataFrame(rows, "id string, x double, z double, k string, y double, y_log double, fecha string").withColumn(
        "fecha", F.col("fecha").cast("date")).cache()


def test_ridge_equals_the_closed_form(data):
    pdf = data.toPandas()
    hot = np.stack([(pdf.k == f"k{j}").to_numpy(float) for j in range(4)], axis=1)
    design = np.column_stack([pdf.x, pdf.z, hot])
    centred = design - design.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred + 2.0 * np.eye(6), centred.T @ (pdf.y_log - pdf.y_log.mean()))
    model = models.fit_ridge(data, alpha=2.0, columns=SMALL).stages[-1]
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-6)
    assert model.intercept == pytest.approx(pdf.y_log.mean() - design.mean(axis=0) @ want, abs=1e-6)


def test_unknown_label_is_all_zeros(spark, data):
    model = models.fit_ridge(data, columns=SMALL)
    row = data.limit(1).withColumn("k", F.lit("never seen"))
    weights = model.stages[-1].coefficients.toArray()
    r = models.predict(model, row, clipped=False, columns=SMALL).first()
    assert np.log1p(r.pred) == pytest.approx(model.stages[-1].intercept + weights[0] * r.x + weights[1] * r.z)


def test_trees_know_the_labels_and_beat_the_median(data):
    params = models.BoostingParams(4, 15, 0.3)
    train, test = data.filter("fecha < '2024-01-22'"), data.filter("fecha >= '2024-01-22'")
    model, scored = models.final_fit_predict(train, test, params, columns=SMALL)
    assert scored.count() == data.count()
    got = regression_metrics(scored.filter("fecha >= '2024-01-22'"), "y", "pred", by=()).first()
    base = baselines.lookup_predict(test, baselines.group_median_model(train, ["k"], "y", "continuous"), ["k"])
    assert got.rmsle < 0.5 * regression_metrics(base, "y", "pred", by=()).first().rmsle

    importance = models.permutation_importance(model, data, SMALL)
    order = [r.variable for r in importance.collect()]
    assert order[:2] == ["x", "k"] and importance.first().importancia > 0.5


def test_importance_of_trees_bins_rows_once_and_equals_that_of_scored_rows(data, monkeypatch):
    train, number = data.filter("k <> 'k3'"), F.substring("id", 3, 9).cast("int")
    odd = data.withColumns({"x": F.when(number % 7 != 0, F.col("x")), "k": F.when(number % 5 != 0, F.col("k")),
                            "y_log": F.when(number % 11 != 0, F.col("y_log"))})
    model = models.fit_gbt(train, models.BoostingParams(None, 5, 0.3), SMALL)
    with monkeypatch.context() as m:
        m.setattr(models, "_tree_scores", models._row_scores)
        wanted = models.permutation_importance(model, odd, SMALL).collect()
    monkeypatch.setattr(type(model), "transform", None)
    got = models.permutation_importance(model, odd, SMALL).collect()
    assert [r.variable for r in got] == [r.variable for r in wanted]
    for name in ("importancia", "desviacion"):
        assert np.allclose([r[name] for r in got], [r[name] for r in wanted], atol=1e-9)


def test_forward_search_picks_the_smallest_error(data):
    grid = (models.BoostingParams(1, 2, 0.05), models.BoostingParams(4, 10, 0.3))
    best, found = models.forward_search(data, forward_windows("2024-01-01", "2024-01-29", 3), grid, columns=SMALL)
    rows = found.collect()
    assert best == grid[1] and len(rows) == 2 and all(len(r.rmsle_por_ventana) == 3 for r in rows)
    assert rows[1].rmsle_promedio < rows[0].rmsle_promedio


def test_jobs_of_a_search_do_not_grow_with_its_trees(spark, data):
    windows, jobs = forward_windows("2024-01-01", "2024-01-29", 3), []
    for trees in (2, 30):
        spark.sparkContext.setJobGroup(f"search of {trees}", "")
        models.forward_search(data, windows, (models.BoostingParams(3, trees, 0.1),), columns=SMALL)[1].collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"search of {trees}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 2


def test_median_model_falls_back_to_the_global_median(spark):
    train = spark.createDataFrame([(1, 10), (1, 30), (2, 50), (None, 70)], "k int, trip_duration int")
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    for bounded in (True, False):
        got = baselines.lookup_predict(rows, baselines.group_median_model(train, ["k"]), ["k"], keys_bounded=bounded)
        assert {r.k: r.pred for r in got.collect()} == {1: 20.0, 2: 50.0, 3: 40.0, None: 40.0}


def test_zones_learn_from_training_pickups_only(spark):
    rows = [(40.0 + (i % 2), -74.0, "train") for i in range(100)] + [(10.0, 10.0, "test")] * 50
    df = spark.createDataFrame(rows, "pickup_latitude double, pickup_longitude double, split_flag string")
    found = sorted(zones.centroids_of(zones.fit_zones(df, k=2)))
    assert found == [(pytest.approx(40.0), -74.0), (pytest.approx(41.0), -74.0)]


def test_canonical_order():
    assert MODEL.ordered[:7] == MODEL.numeric and MODEL.ordered[7:] == MODEL.categorical
