"""Column expressions on literal cases with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from tripstrata.config import MODEL, RAW_TYPES, THRESHOLDS
from tripstrata.functions import calendar, geo, numeric, typing
from tripstrata.operators import quality
from tripstrata.operators.alerts import degradation_level
from tripstrata.operators.drift import classify_psi
from tripstrata.operators.evaluation import reading_columns
from tripstrata.sources.readers import raw_columns


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_duration_rule(spark):
    cases = [(0, False), (1, True), (455, True), (21600, True), (21601, False), (86400, False)]
    got = values(spark, [(n,) for n, _ in cases], "x int", quality.rule_range("x", 1, 21600))
    assert got == [ok for _, ok in cases]


def test_passenger_rule(spark):
    cases = [(0, False), (1, True), (6, True), (7, False)]
    assert values(spark, [(n,) for n, _ in cases], "x int", quality.rule_range("x", 1, 6)) == [ok for _, ok in cases]


def test_box_needs_both_coordinates(spark):
    rows = [(40.7679, -73.9822), (0.0, 0.0), (40.7679, 0.0), (40.5, -74.3), (41.0, -73.7)]
    assert values(spark, rows, "a double, b double", quality.rule_bbox(("a", "b"))) == [True, False, False, True, True]


MIDTOWN = (40.7679, -73.9822)


def trip(spark, expression_of, *points):
    rows = [tuple(float(x) for x in p) for p in points]
    return values(spark, rows, "a double, b double, c double, d double", expression_of(*[F.col(c) for c in "abcd"]))


def test_haversine(spark):
    same, degree, there, back, sample = trip(
        spark, geo.haversine_km, (*MIDTOWN, *MIDTOWN), (0, 0, 1, 0), (*MIDTOWN, 40.7656, -73.9646),
        (40.7656, -73.9646, *MIDTOWN), (40.767936706542969, -73.982154846191406, 40.765602111816406, -73.964630126953125))
    assert same == 0 and abs(degree - 111.19) < 0.1 and math.isclose(there, back) and 1 < sample < 2


def test_haversine_of_antipodes_is_a_number(spark):
    (half,) = trip(spark, geo.haversine_km, (0, 0, 0, 180))
    assert math.isclose(half, math.pi * 6371.0088)


def test_manhattan(spark):
    points = [(40.7679, -73.9822, 40.7061, -74.0087), (40.70, -74.0, 40.80, -74.0)]
    grid, line = trip(spark, geo.manhattan_km, *points), trip(spark, geo.haversine_km, *points)
    assert grid[0] >= line[0] and abs(grid[1] - line[1]) < 1e-6


def test_bearing(spark):
    ends = [(40.80, -74.0), (40.70, -73.9), (40.8, -74.1), (40.6, -73.8), (40.75, -73.99)]
    got = trip(spark, geo.bearing_deg, *[(40.70, -74.00, *e) for e in ends])
    assert abs(got[0]) < 0.1 and abs(got[1] - 90) < 0.1 and all(0 <= b < 360 for b in got)


def test_weekend(spark):
    assert values(spark, [(d,) for d in (1, 7, 2, 4, 6)], "d int", calendar.weekend_flag(F.col("d"))) == [1, 1, 0, 0, 0]


def test_calendar_of_a_sunday(spark):
    df = spark.createDataFrame([("2016-01-03 23:15:00",)], "t string").select(F.col("t").cast("timestamp").alias("pickup_datetime"))
    row = calendar.temporal_features(df).first()
    assert (row.pickup_hour, row.pickup_dayofweek, row.pickup_month, row.is_weekend) == (23, 1, 1, 1)


def test_speed(spark):
    got = values(spark, [(10.0, 1800), (5.0, 0)], "km double, s int", geo.speed_kmh(F.col("km"), F.col("s")))
    assert got == [20.0, 0.0]


def test_near_any(spark):
    jfk, lga = THRESHOLDS.sites["JFK"], THRESHOLDS.sites["LGA"]
    rows = [(*jfk, *MIDTOWN), (*MIDTOWN, *lga), (*MIDTOWN, 40.7505, -73.9934)]
    df = spark.createDataFrame(rows, "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double")
    assert [r[0] for r in df.select(geo.near_any()).collect()] == [1, 1, 0]


def test_nearest_prefers_the_lower_index_on_a_tie(spark):
    got = values(spark, [(0.0, 0.0), (0.0, 2.0), (0.0, 1.0), (None, 1.0)], "a double, b double",
                 geo.nearest(F.col("a"), F.col("b"), [(0.0, 0.0), (0.0, 2.0)]))
    assert got == [0, 1, 0, None]


def test_flag(spark):
    cases = [("Y", 1), ("y", 1), (" Y ", 1), ("N", 0), ("n", 0), (None, None), ("X", None)]
    assert values(spark, [(c,) for c, _ in cases], "f string", typing.map_flag(F.col("f"))) == [v for _, v in cases]


def test_types_follow_the_present_columns():
    train, scoring = typing.columns_to_type(raw_columns("train") + ["_row_hash"]), typing.columns_to_type(raw_columns("scoring"))
    assert "trip_duration" in train and "dropoff_datetime" in train and "pickup_datetime" in scoring
    assert "trip_duration" not in scoring and "dropoff_datetime" not in scoring
    assert not any(c.startswith("_") for c in train)
    assert all(RAW_TYPES[c] == "double" for c in RAW_TYPES if c.endswith(("itude",)))
    assert RAW_TYPES["id"] == RAW_TYPES["vendor_id"] == "string" and RAW_TYPES["trip_duration"] == "int"


def test_split_day_is_test(spark):
    rows = [("2016-01-15 08:30:00",), ("2016-06-20 08:30:00",), ("2016-06-17 00:00:00",), ("2016-06-16 23:59:59",), (None,)]
    got = values(spark, rows, "t string", calendar.temporal_split("t"))
    assert got == ["train", "test", "test", "train", "train"]


def test_forward_windows():
    assert calendar.forward_windows("2016-01-01", "2016-06-17", 3) == [
        {"ventana": 1, "entrena_hasta": "2016-02-12", "valida_hasta": "2016-03-25"},
        {"ventana": 2, "entrena_hasta": "2016-03-25", "valida_hasta": "2016-05-06"},
        {"ventana": 3, "entrena_hasta": "2016-05-06", "valida_hasta": "2016-06-17"},
    ]


def test_bands_are_right_closed(spark):
    x = [0.0, 0.5, 1.0, 1.01, 20.0, 20.1, None]
    got = values(spark, [(v,) for v in x], "x double", numeric.bucket_right_closed(F.col("x")))
    assert got == [None, 0, 0, 1, 6, 7, None]
    closed = values(spark, [(v,) for v in (0.0, 100.0, 100.1)], "x double",
                    numeric.bucket_right_closed(F.col("x"), (0.0, 2.0, 100.0), open_end=False))
    assert closed == [None, 1, None]


def test_clip(spark):
    assert values(spark, [(0.2,), (50.0,), (9e9,), (None,)], "x double", numeric.clip(F.col("x"))) == [1.0, 50.0, 21600.0, None]


def test_model_columns():
    assert set(MODEL.categorical) | set(MODEL.numeric) == set(MODEL.whitelist)
    assert not set(MODEL.categorical) & set(MODEL.numeric)
    assert MODEL.ordered == MODEL.numeric + MODEL.categorical
    assert [MODEL.ordered[i] for i in MODEL.categorical_indices()] == list(MODEL.categorical)


def test_whitelist_leaks_nothing():
    quality.assert_no_leakage([*MODEL.whitelist, MODEL.target, MODEL.target_log])
    with pytest.raises(ValueError, match="velocidad_kmh"):
        quality.assert_no_leakage([*MODEL.whitelist, "velocidad_kmh"])


def test_business_reading(spark):
    row = reading_columns(spark.createDataFrame([(180.0, 660.0), (900.0, 600.0)], "m double, d double"), "m", "d").collect()
    assert tuple(row[0]) == (3.0, 11.0, 27.3, 8.0, 14.0)
    assert row[1].ventana_min == 0.0


def test_states(spark):
    assert values(spark, [(0.09,), (0.1,), (0.25,)], "p double", classify_psi(F.col("p"))) == ["estable", "vigilar", "alerta"]
    got = values(spark, [(1.0, 1.0), (1.2, 1.0), (1.4, 1.0), (None, 1.0)], "m double, r double",
                 degradation_level(F.col("m"), F.col("r")))
    assert got == ["normal", "atencion", "critico", None]
