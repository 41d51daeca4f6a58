"""Boosted trees against a brute-force search, and what they must know."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstrata.operators import boosting as bo


def sides_of(columns, kinds, own, rows, least):
    """Every way to split ``rows``: thresholds, and all subsets of labels; where leaves have a least size, which can rule out the
    best subset, the subsets that sorted means give."""
    for x, kind in zip(columns, kinds):
        values = x[rows]
        known = sorted(set(values.tolist()), key=None if kind == "number" else lambda v: own[values == v].mean())
        if kind == "number":
            yield from (values <= v for v in known[:-1])
        elif least == 1:
            yield from (np.isin(values, chosen) for n in range(1, len(known)) for chosen in combinations(known, n))
        else:
            yield from (np.isin(values, known[:n]) for n in range(1, len(known)))


def brute(columns, kinds, y, rows, least):
    """The best gain and the first side that has it."""
    best, found = 0.0, None
    own = y[rows]
    for side in sides_of(columns, kinds, own, rows, least):
        if least <= side.sum() <= len(own) - least:
            gain = own[side].sum() ** 2 / side.sum() + own[~side].sum() ** 2 / (~side).sum() - own.sum() ** 2 / len(own)
            if gain > best + 1e-9:
                best, found = gain, side
    return best, found


def grown(columns, kinds, y, leaves, depth, least):
    """Residual means per row of a tree grown best first."""
    groups = [(np.arange(len(y)), 0)]
    while len(groups) < leaves:
        tried = [brute(columns, kinds, y, g, least) if (depth is None or d < depth) and len(g) >= 2 * least else (0.0, None)
                 for g, d in groups]
        k = max(range(len(groups)), key=lambda i: tried[i][0])
        side = tried[k][1]
        if side is None:
            break
        rows, d = groups.pop(k)
        groups += [(rows[side], d + 1), (rows[~side], d + 1)]
    out = np.empty(len(y))
    for g, _ in groups:
        out[g] = y[g].mean()
    return out


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.RandomState(5)
    n = 300
    x, z, k = rng.rand(n).round(2), rng.randint(0, 6, n).astype(float), rng.choice(list("abcdef"), n)
    y = 2 * x + (z == 3) + np.where(np.isin(k, ["b", "e"]), 1.5, 0) * (x > 0.4) + 0.3 * rng.randn(n)
    rows = spark.createDataFrame([(float(a), float(b), str(c), float(d), i % 28) for i, (a, b, c, d) in enumerate(zip(x, z, k, y))],
                                 "x double, z double, k string, y double, n int")
    return rows.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))).repartition(3), (x, z, k), y


@pytest.mark.parametrize("leaves, depth, least", [(2, None, 1), (9, None, 1), (31, 3, 1), (31, 3, 10), (12, 4, 20), (300, None, 15)])
def test_splits_equal_a_brute_force_search(small, leaves, depth, least):
    rows, columns, y = small
    params = bo.BoostingParams(depth, 1, 1.0, leaves, least)
    model = bo.fit_boosting(rows, ["x", "z"], ["k"], "y", params)
    got = {(r.x, r.z, r.k): r.pred_log for r in model.transform(rows).collect()}
    want = grown(columns, ["number", "number", "label"], y, leaves, depth, least)
    for a, b, c, w in zip(*columns, want):
        assert got[(a, b, c)] == pytest.approx(w, abs=1e-9)
    assert (model.trees[0].left == np.arange(len(model.trees[0].left))).sum() <= leaves


def test_shared_passes_equal_single_fits(small, monkeypatch):
    rows, _, _ = small
    bins = bo.fit_bins(rows, ["x", "z"], ["k"])
    settings = [bo.BoostingParams(2, 6, 0.3), bo.BoostingParams(None, 4, 0.5, 6, 10)]
    days = [19_723 + 15, 19_723 + 22]  # 2024-01-01 is day 19723
    fits = [bo.Fit(p, d) for p in settings for d in days]
    blocks = bo.binned_blocks(rows, bins, "y", "day", block_rows=70)
    models, state = bo.train(blocks, bins, fits)
    counts, errors = bo.forward_errors(state, [(f.until, f.until + 6) for f in fits], 0.0, 1e9)
    state.unpersist()
    monkeypatch.setattr(bo, "REBASE", 2)
    for fit, model, error, count in zip(fits, models, errors, counts):
        alone, own_state = bo.train(blocks, bins, [fit])
        own_state.unpersist()
        assert len(alone[0].trees) == fit.params.max_iter == len(model.trees)
        known = F.unix_date("day")
        scored = alone[0].transform(rows.filter((known >= fit.until) & (known < fit.until + 6)))
        shared = {r.n: r.pred_log for r in model.transform(scored.drop("pred_log")).collect()}
        assert {r.n: pytest.approx(r.pred_log) for r in scored.collect()} == shared
        miss = scored.agg(F.sqrt(F.avg(F.pow(F.greatest("pred_log", F.lit(0.0)) - F.col("y"), 2))).alias("e")).first().e
        assert error == pytest.approx(miss) and count == scored.count()


def test_missing_and_unknown_values(spark):
    rows = [(None if i % 4 == 0 else float(i % 7), None if i % 5 == 0 else "ab"[i % 2], 5.0 * (i % 4 == 0) + 2.0 * (i % 5 == 0)) for i in range(400)]
    rows += [(float("nan"), "a", 5.0), (1.0, "b", None)]
    frame = spark.createDataFrame(rows, "x double, k string, y double")
    model = bo.fit_boosting(frame, ["x"], ["k"], "y", bo.BoostingParams(4, 30, 0.5, 8, 5))
    asked = spark.createDataFrame([(None, "a"), (float("nan"), "a"), (3.0, "a"), (3.0, None), (3.0, "never"), (None, None)], "x double, k string")
    got = [r.pred_log for r in model.transform(asked).collect()]
    assert got == pytest.approx([5, 5, 0, 2, 2, 7], abs=0.2)
    with pytest.raises(ValueError):
        bo.fit_boosting(frame.limit(0), ["x"], ["k"], "y")


def test_kept_models_score_alike(spark, small, tmp_path):
    rows, _, _ = small
    model = bo.fit_boosting(rows, ["x", "z"], ["k"], "y", bo.BoostingParams(None, 5, 0.3))
    model.save(spark, str(tmp_path / "model"))
    loaded = bo.BoostedTrees.load(spark, str(tmp_path / "model"))
    assert loaded.bins == model.bins and loaded.params == model.params
    a, b = (sorted(r.pred_log for r in m.transform(rows).collect()) for m in (model, loaded))
    assert a == b


def test_many_values_and_labels_share_bins(spark):
    rows = spark.range(20_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 400).cast("string").alias("k"))
    bins = bo.fit_bins(rows, ["x"], ["k"])
    assert 200 <= len(bins.cuts[0]) <= 254 and len(bins.labels[0]) == 255 and max(bins.sizes) <= 256
    encoded = bins.encode([np.array([-1.0, 19_999.0, np.nan]), np.array(["0", "never", None], object)])
    assert encoded[0].tolist() == [0, len(bins.cuts[0]), len(bins.cuts[0]) + 1] and encoded[1, 1] == encoded[1, 2] == 255


def test_passes_send_counts_in_the_smallest_type_and_small_tables_have_few_tasks(spark):
    n, s = bo.packed_counts(np.array([[[0.0, 300.0]], [[0.5, -2.0]]]))
    assert n.dtype == np.uint16 and n.tolist() == [[0, 300]] and s.tolist() == [[0.5, -2.0]]
    total = bo.add_counts((n, s), (np.array([[65535, 65535]], np.uint16), s))
    assert total[0].tolist() == [[65535, 65835]] and total[1].tolist() == [[1.0, -4.0]]
    rows = spark.range(0, 4000, 1, 8).selectExpr("double(id % 100) AS x", "string(id % 3) AS k", "double(id % 100) AS y")
    bins = bo.fit_bins(rows, ["x"], ["k"])
    blocks = bo.binned_blocks(rows, bins, "y", block_rows=100).coalesce(1)
    models, state = bo.train(blocks, bins, [bo.Fit(bo.BoostingParams(3, 2, 0.5))])
    assert state.getNumPartitions() == 1
    assert models[0].trees[0].depth == 3
    state.unpersist()


def test_fits_grown_whole_in_tasks_equal_shared_passes(small, monkeypatch):
    rows, _, _ = small
    rows = rows.withColumns({"x": F.when(F.col("n") % 9 != 0, F.col("x")), "k": F.when(F.col("n") % 11 != 0, F.col("k")),
                             "y": F.when(F.col("n") % 13 != 0, F.col("y"))})
    bins = bo.fit_bins(rows, ["x", "z"], ["k"])
    blocks = bo.binned_blocks(rows, bins, "y", "day", block_rows=40)
    settings = [bo.BoostingParams(2, 6, 0.3), bo.BoostingParams(None, 9, 0.2, 12, 5), bo.BoostingParams(4, 3, 0.5, 31, 1)]
    fits = [bo.Fit(p, d) for p in settings for d in (19_723 + 9, 19_723 + 20)] + [bo.Fit(settings[0])]
    checks = [(f.until, f.until + 8) for f in fits[:-1]] + [(30_000, 30_001)]  # the last has nothing to check
    shared = bo.validate(blocks, bins, fits, checks, 0.0, 1e9, task_bytes=0)
    # Rows of a node are counted in several parts.
    monkeypatch.setattr(bo, "COUNTED_ROWS", 30)
    monkeypatch.setattr(bo, "train", None)
    whole = bo.validate(blocks, bins, fits, checks, 0.0, 1e9)
    assert whole[0] == shared[0] and whole[1] == pytest.approx(shared[1], abs=1e-12)
    assert min(whole[0][:-1]) > 0 and whole[0][-1] == 0 and whole[1][-1] == 0
    with pytest.raises(ValueError):
        bo.validate(blocks, bins, [bo.Fit(settings[0], 19_723)], [(19_723, 19_730)], 0.0, 1e9)


def test_a_held_tree_leaves_its_values_in_the_residuals():
    rng = np.random.RandomState(8)
    bins = bo.Bins(("x",), ("k",), (tuple(range(9)),), (tuple("abcd"),))
    encoded = np.array([rng.randint(0, 11, 500), rng.randint(0, 5, 500)], np.uint8)
    y = rng.randn(500) + (encoded[0] > 6) - 2.0 * (encoded[1] == 2)
    held = bo.HeldRows(encoded, y - y.mean(), bins)
    trees = tuple(held.grow(bo.BoostingParams(None, 4, 0.5, 7, 10)) for _ in range(4))
    assert all((tree.left == np.arange(len(tree.left))).sum() <= 7 for tree in trees)
    model = bo.BoostedTrees(bins, y.mean(), trees, bo.BoostingParams(None, 4, 0.5, 7, 10))
    assert np.allclose(held.residual, y - model.raw(encoded), atol=1e-12)
