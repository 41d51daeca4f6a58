"""Quantiles, effects, shape and PSI against brute force in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstrata.operators import drift, effects, evaluation, quantiles, scenarios
from tripstrata.operators.ordering import running_total

RNG = random.Random(7)


def sample(kind, n):
    if kind == "wide":
        return [math.copysign(10 ** RNG.uniform(-9, 9), RNG.random() - 0.5) for _ in range(n)]
    if kind == "close":  # all within one step of the magnitude scale
        return [1.7e9 + RNG.random() for _ in range(n)]
    if kind == "ties":
        return [float(RNG.choice([0, 0, 0, 0, 1, 5])) for _ in range(n)]
    return [RNG.gauss(0, 3) for _ in range(n)]


@pytest.fixture(scope="module")
def groups(spark):
    data = {("hot", "wide"): sample("wide", 4000), ("b", "close"): sample("close", 700), ("c", "ties"): sample("ties", 900),
            (None, "gauss"): sample("gauss", 801), ("one", "one"): [3.25], ("two", "two"): [-1.0, 4.0]}
    rows = [(k, v) for (k, _), vs in data.items() for v in vs] + [("hot", None), ("gone", None)]
    RNG.shuffle(rows)
    return {k: vs for (k, _), vs in data.items()}, spark.createDataFrame(rows, "k string, v double").repartition(7)


@pytest.mark.parametrize("domain", ["continuous", "discrete"])
def test_quantiles_match_linear_interpolation(groups, domain):
    data, df = groups
    probabilities = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    names = [f"q{i}" for i in range(len(probabilities))]
    got = {r.k: r for r in quantiles.quantiles(df, ["k"], "v", probabilities, names, domain).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        ordered = sorted(vs)
        for name, p in zip(names, probabilities):
            place = p * (len(vs) - 1)
            low = math.floor(place)
            high = min(low + 1, len(vs) - 1)
            assert got[k][name] == pytest.approx(ordered[low] + (ordered[high] - ordered[low]) * (place - low), rel=1e-12, abs=1e-12)


def test_lower_quantiles(groups):
    data, df = groups
    got = {r.k: r for r in quantiles.lower_quantiles(df, ["k"], "v", [0.5, 0.9], ["a", "b"]).collect()}
    for k, vs in data.items():
        for name, p in (("a", 0.5), ("b", 0.9)):
            assert got[k][name] == sorted(vs)[max(math.ceil(p * len(vs)) - 1, 0)]


def test_quantiles_of_a_whole_table(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    row = quantiles.quantiles(df, [], "x", [0.0, 0.5, 1.0], ["a", "b", "c"]).first()
    assert tuple(row) == (100, 1.0, 50.5, 100.0)


def test_weighted_counts_equal_repeated_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (9, 2)], "v int, w int")
    row = quantiles.quantiles(df, [], "v", [0.5], ["m"], "discrete", weight="w").first()
    assert (row.n, row.m) == (6, 1.5)


# --- PSI ---------------------------------------------------------------------

def brute_cuts(ref, bins=10):
    s, n = sorted(ref), len(ref)
    return sorted({s[0], s[-1], *[s[int(n * i / bins)] for i in range(1, bins)]})


def brute_shares(values, cuts):
    counts = [0] * (len(cuts) - 1)
    for v in values:
        fits = [i for i in range(len(counts)) if v < cuts[i + 1] or (i == len(counts) - 1 and v <= cuts[-1])]
        if fits:
            counts[fits[0]] += 1
    return [c / len(values) if values else 0.0 for c in counts]


def brute_psi(ref, new):
    cuts = brute_cuts(ref)
    pairs = zip(brute_shares(ref, cuts), brute_shares(new, cuts))
    return sum((max(a, 1e-6) - max(r, 1e-6)) * math.log(max(a, 1e-6) / max(r, 1e-6)) for r, a in pairs)


def frame(spark, **columns):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def test_psi_matches_brute_force(spark):
    n = 1000
    ref = {"plain": [float(i % 100) for i in range(n)], "skewed": [float(int(x)) for x in np.random.RandomState(1).exponential(3, n)],
           "rare": [1.0 if i % 50 == 0 else 0.0 for i in range(n)], "constant": [5.0] * n}
    new = {"plain": [v + 30 for v in ref["plain"]], "skewed": [v * 2 - 1 for v in ref["skewed"]],
           "rare": [1.0 if i % 2 == 0 else 0.0 for i in range(n)], "constant": [4.0] * n}
    got = {r.variable: r for r in drift.psi_by_variable(frame(spark, **ref), frame(spark, **new), list(ref)).collect()}
    for c in ref:
        assert got[c].psi == pytest.approx(brute_psi(ref[c], new[c]), rel=1e-9, abs=1e-12), c
    assert got["rare"].psi == 0 and got["constant"].psi == 0
    by_category = drift.categorical_psi(frame(spark, **ref), frame(spark, **new), ["rare"]).first()
    assert by_category.psi > 0.25


def test_psi_of_the_same_and_of_a_shifted_sample(spark):
    base = [float(i % 100) for i in range(1000)]
    same = drift.drift_report(frame(spark, a=base), frame(spark, a=base), ["a"]).first()
    moved = drift.drift_report(frame(spark, a=base), frame(spark, a=[v + 200 for v in base]), ["a"]).first()
    assert same.psi < 0.10 and not same.alerta
    assert moved.estado == "alerta" and moved.alerta and moved.n_en_alerta == 1


def test_drift_skips_what_the_batch_lacks_and_copes_with_nothing(spark):
    ref = frame(spark, a=[1.0, 2.0, 3.0], b=[1.0, 2.0, 3.0])
    assert [r.variable for r in drift.drift_report(ref, ref.select("a"), ["a", "b"]).collect()] == ["a"]
    empty = drift.psi_by_variable(ref, ref.filter("a > 9"), ["a"]).first()
    assert empty.psi == pytest.approx(brute_psi([1.0, 2.0, 3.0], [])) and empty.n_lote == 0
    assert drift.psi_by_variable(ref.filter("a > 9"), ref, ["a"]).count() == 0


# --- Effects -----------------------------------------------------------------

def eta(spark, values, groups):
    df = spark.createDataFrame([(float(v), str(g)) for v, g in zip(values, groups)], "v double, g string")
    return effects.eta_squared(df, "v", "g").first().eta2


def test_eta_squared(spark):
    assert eta(spark, [1, 1, 1, 5, 5, 5], "aaabbb") == pytest.approx(1.0)
    assert eta(spark, [1, 5, 1, 5], "aabb") == pytest.approx(0.0)
    assert eta(spark, [2, 2, 2], "aab") == 0.0
    assert 0 <= eta(spark, [3, 1, 4, 1, 5, 9, 2, 6], "01012210") <= 1
    assert eta(spark, [10, 2, 1, 2, 10] * 4, [0, 6, 12, 18, 23] * 4) > 0.9


def test_effects_of_a_far_mean_do_not_cancel(spark):
    values, groups = [1e9 + v for v in (1, 2, 3, 11, 12, 13)], "aaabbb"
    assert eta(spark, values, groups) == pytest.approx(eta(spark, [1, 2, 3, 11, 12, 13], groups), rel=1e-6)


def test_shape(spark):
    def shape(xs):
        return effects.distribution_shape(spark.createDataFrame([(x,) for x in xs], "x int"), "x", scale=1.0).first()

    flat, tail = shape([1, 2, 3, 4, 5]), shape([1, 1, 1, 1, 2, 2, 3, 20])
    assert abs(flat.asimetria) < 1e-9 and flat.mediana_min == 3 and tail.asimetria > 1
    assert shape([1] * 7 + [50]).curtosis > 0


def test_regression_and_residuals(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x, 5.0) for x in range(1, 7)], "x double, y double, c double")
    fit = effects.simple_regression(df, "x", "y").first()
    assert (fit.pendiente, fit.r2) == (pytest.approx(2.0), pytest.approx(1.0)) and abs(fit.intercepto) < 1e-9
    assert effects.simple_regression(df, "x", "c").first().r2 == 0.0
    assert tuple(effects.simple_regression(df, "c", "y").first()) == (0.0, 0.0, 0.0)
    residuals = effects.with_residual(df, "x", "y")
    assert all(abs(r.residuo) < 1e-9 for r in residuals.collect())


# --- Metrics -----------------------------------------------------------------

def test_metrics(spark):
    df = spark.createDataFrame([("m", 10.0, 12.0), ("m", 20.0, 24.0), ("p", 100.0, 100.0), ("p", 200.0, 200.0), ("n", 5.0, -3.0)],
                               "modelo string, real double, pred double")
    got = {r.modelo: r for r in evaluation.regression_metrics(df, "real", "pred").collect()}
    assert got["m"].mae_min * 60 == pytest.approx(3.0)
    assert got["p"].rmse_min == 0 and got["p"].r2 == 1
    assert got["n"].rmsle == pytest.approx(math.log1p(5)) and got["n"].r2 == 0.0


def test_overfit_gap(spark):
    df = spark.createDataFrame([("train", 100.0), ("test", 150.0)], "split_flag string, mae_min double")
    row = evaluation.overfit_gap(df, names=["mae_min"]).first()
    assert (row.train, row.test, row.brecha_absoluta, row.brecha_relativa_pct) == (100.0, 150.0, 50.0, 50.0)


# --- Ordering and scenarios --------------------------------------------------

def test_running_total_over_ranges(spark):
    rows = [(i, RNG.randint(1, 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(5)
    got = running_total(df, [F.desc("n"), F.col("k")], "n", "upto").collect()
    total, want = 0, {}
    for k, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += n
        want[k] = total
    assert {r.k: r.upto for r in got} == want


def batch(spark, n=600):
    rows = [(f"id{i}", i % 24, i % 7 if i % 3 else 0, float(i % 90) / 4, float(i % 80) / 3) for i in range(n)]
    return spark.createDataFrame(rows, "id string, pickup_hour int, pickup_cluster int, distancia_haversine_km double, distancia_manhattan_km double")


def test_sweep_equals_materialised_scenarios(spark):
    columns = ["pickup_hour", "pickup_cluster", "distancia_haversine_km", "distancia_manhattan_km"]
    reference, new = batch(spark, 900), batch(spark, 700)
    got = {(r.escenario, r.intensidad, r.variable): r.psi
           for r in scenarios.sweep_psi(reference, new, columns, (0.0, 0.5, 2.0)).collect()}
    made = {
        (scenarios.NIGHT, 0.5): scenarios.resample_share(new, 0.5), (scenarios.ZONES, 2.0): scenarios.thin_top_categories(new, 2.0),
        (scenarios.DISTANCE, 0.5): scenarios.scale_columns(new, 0.5), (scenarios.NIGHT, 0.0): new,
    }
    for (name, i), df in made.items():
        for r in drift.psi_by_variable(reference, df, columns).collect():
            assert got[name, i, r.variable] == pytest.approx(r.psi, rel=1e-9, abs=1e-12), (name, i, r.variable)


def test_resampling_raises_the_share_and_keeps_the_size(spark):
    new = batch(spark, 6000)
    more = scenarios.resample_share(new, 1.0)
    before, after = (df.agg(F.avg(scenarios.is_night().cast("double"))).first()[0] for df in (new, more))
    assert after == pytest.approx(2 * before, rel=0.05) and more.count() == pytest.approx(6000, rel=0.05)
