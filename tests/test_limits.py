"""What must hold for odd inputs: many labels, NULL categories, tiny samples, hashes that do not cover the key."""

import re

import pytest
from pyspark.sql import functions as F

from tripstrata.config import ModelColumns
from tripstrata.operators import effects, evaluation, models, ordering, scenarios
from tripstrata.sources import audit


def test_trees_take_many_labels(spark):
    columns = ModelColumns(numeric=("x",), categorical=("zone",), target="y", target_log="y_log")
    rows = spark.range(1400).select(
        "id", (F.col("id") % 13).cast("double").alias("x"), F.concat(F.lit("z"), (F.col("id") % 70).cast("string")).alias("zone"),
        (F.col("id") % 70 * 10 + 60).cast("double").alias("y")).withColumn("y_log", F.log1p("y"))
    model = models.fit_gbt(rows, models.BoostingParams(3, 3, 0.3), columns)
    assert models.predict(model, rows, columns=columns).filter("pred > 0").count() == 1400


@pytest.mark.parametrize("depth", [None, 31])
def test_trees_need_a_depth(depth):
    with pytest.raises(ValueError):
        models.gbt_regressor(models.BoostingParams(depth, 1, 0.1))


def test_missing_zones_are_no_top_zone(spark):
    rows = [(i, None) for i in range(60)] + [(100 + i, i % 3) for i in range(60)] + [(900, 7)]
    df = spark.createDataFrame(rows, "id long, pickup_cluster int")
    kept = scenarios.thin_top_categories(df, 0.95)
    counts = {r.pickup_cluster: r["count"] for r in kept.groupBy("pickup_cluster").count().collect()}
    assert counts[None] == 60 and counts[7] == 1 and all(counts.get(z, 0) < 8 for z in range(3))


def test_samples_have_the_size_asked_for(spark):
    for start in range(0, 30_000, 1000):
        assert ordering.sample_rows(spark.range(start, start + 1000), 1, "id").count() == 1
    assert ordering.sample_rows(spark.range(5), 9, "id").count() == 5


def test_hashes_need_not_cover_the_key(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "b"), (None, "c")], "id long, _row_hash string")
    check = audit.load_check(rows).first()
    assert (check.n_filas, check.n_hash, check.n_ids) == (5, 3, 4)
    assert audit.load_check(rows.limit(0)).first().n_hash == 0


def test_quantiles_of_continuous_values_use_no_single_task(spark):
    df = spark.range(1000).select(F.rand(1).alias("real"), F.rand(2).alias("pred")).withColumn("residuo_min", F.col("pred"))
    for frame in (effects.distribution_shape(df, "real"), evaluation.business_reading(df, "real", "pred"),
                  evaluation.tail_contribution(df, "real")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Window[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_session_keeps_what_is_decided(spark):
    from tripstrata.session import DEFAULTS, get_session

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    assert get_session("tests").conf.get(key) == "64m"
    spark.conf.set(key, before)
    assert spark.conf.get("spark.sql.session.timeZone") == DEFAULTS["spark.sql.session.timeZone"]
