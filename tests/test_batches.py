"""Weeks and late deliveries in any order equal one full run."""

import datetime
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from oracle_base import CENTROIDS
from tripstrata.config import THRESHOLDS
from tripstrata.operators.demand import demand_aggregate
from tripstrata.plans import batches
from tripstrata.plans.silver import flagged_trips
from tripstrata.sources.event_trips import raw_trips
from tripstrata.streaming import copies, demand_state
from tripstrata.streaming.incremental import incremental_batch, partitions, replace_days

LIMITS = replace(THRESHOLDS, split_cutoff="2024-01-24")
SPAN = "pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-29'"


def full_run(raw):
    rows = batches.hashed(raw).filter(SPAN).withColumns({"fecha": F.to_date("pickup_datetime"), "lote": F.lit("x")})
    return batches.layer_frames(flagged_trips(rows, LIMITS), CENTROIDS, LIMITS)


def same(stored, wanted):
    for name in batches.LAYERS:
        columns = [c for c in wanted[name].columns if c != "lote"]
        assert sorted(stored[name].columns) == sorted(wanted[name].columns)
        a, b = stored[name].select(columns), wanted[name].select(columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    a, b = stored["demand"], demand_aggregate(wanted["analytics"])
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, "demand"


@pytest.fixture(scope="module")
def raw(spark, sf):
    rows = raw_trips(spark, sf)
    return rows.withColumn("n", F.substring("id", 3, 20).cast("long"))


def test_weeks_in_any_order_with_copies_and_an_emptied_day(spark, raw, tmp_path):
    folder = str(tmp_path / "layers")
    rows = raw.drop("n")
    twice = rows.unionByName(rows)
    emptied = rows.filter("pickup_datetime NOT LIKE '2024-01-17%'")
    for source, date in ((rows, "2024-01-29"), (rows, "2024-01-22"), (twice, "2024-01-15"), (emptied, "2024-01-22")):
        stored = batches.run_batch(source, date, folder, CENTROIDS, LIMITS)
    same(stored, full_run(emptied))
    assert stored["quality"].count() == 5
    for name in (*batches.LAYERS, "filters"):
        assert "2024-01-17" not in {p["fecha"] for p in partitions(spark, f"{folder}/{name}", 2)}


def test_late_deliveries_add_only_new_rows(spark, raw, tmp_path):
    folder = str(tmp_path / "layers")
    first, late = raw.filter("n % 3 <> 0").drop("n"), raw.filter("n % 3 = 0 OR n % 5 = 0").filter(SPAN).drop("n")
    other = raw.filter("n % 15 = 0").filter(SPAN).drop("n")
    batches.run_batch(first, "2024-01-29", folder, CENTROIDS, LIMITS)
    batches.run_batch(first, "2024-01-22", folder, CENTROIDS, LIMITS, days=14)
    batches.late_batch(late.unionByName(late), "a1", folder, CENTROIDS, LIMITS)
    batches.late_batch(other, "b", folder, CENTROIDS, LIMITS)
    stored = batches.late_batch(late, "a1", folder, CENTROIDS, LIMITS)
    wanted = full_run(raw.drop("n"))
    same(stored, wanted)
    assert stored["clean"].filter("lote = 'b'").count() == 0
    # A delivery that shrinks gives its rows back; a week's run takes over what late ones brought.
    stored = batches.late_batch(late.limit(0), "a1", folder, CENTROIDS, LIMITS)
    same(stored, full_run(first))
    stored = batches.run_batch(raw.drop("n"), "2024-01-29", folder, CENTROIDS, LIMITS, days=21)
    same(stored, wanted)
    for name in ("semana", "1a", "a/b", ""):
        with pytest.raises(ValueError):
            batches.late_batch(late, name, folder, CENTROIDS, LIMITS)


def test_nothing_is_compared_where_filters_exclude_copies(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "layers")
    batches.run_batch(raw.filter("n % 2 = 0").drop("n"), "2024-01-15", folder, CENTROIDS, LIMITS)
    asked = []
    original = batches.stored_hashes
    monkeypatch.setattr(batches, "stored_hashes", lambda s, f, parts: asked.append(parts) or original(s, f, parts))
    late = raw.filter("n % 2 = 1 OR pickup_datetime LIKE '2024-01-09%'").drop("n")
    batches.late_batch(late, "a", folder, CENTROIDS, LIMITS)
    days = {d for d, _ in asked[0]}
    assert "2024-01-09" in days and not any(d >= "2024-01-15" for d in days) and len(days) < 7


def test_raw_rows_are_read_and_typed_once(spark, raw, tmp_path):
    folder, seen = str(tmp_path / "layers"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        seen.add(1)
        return text

    week = raw.filter("pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-15'").drop("n")
    rows, n = week.withColumn("id", noted("id")), week.count()
    batches.run_batch(rows, "2024-01-15", folder, CENTROIDS, LIMITS)
    assert seen.value == n > 0
    stored = batches.late_batch(rows, "a", folder, CENTROIDS, LIMITS)
    assert seen.value == 2 * n and stored["clean"].filter("lote = 'a'").count() == 0


def test_sizes_are_sent_to_the_rows_of_filters(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"))
    key = "spark.sql.autoBroadcastJoinThreshold"  # as for a table whose size says nothing
    usual = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = copies.build_filters(rows, ["part"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, usual)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_filters_hold_all_rows_and_few_others(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 25_000, "a").otherwise("b").alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("_row_hash"))
    filters = copies.build_filters(rows, ["part"])
    sizes = {r.part: r.bitmaps for r in filters.select("part", "bitmaps").distinct().collect()}
    assert sizes == {"a": 8, "b": 2}
    asked = rows.unionByName(spark.range(50_000, 60_000).select(F.lit("a").alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("_row_hash")))
    held = copies.may_hold(asked, filters, "part", ["part"])
    assert held.join(rows, ["part", "_row_hash"]).count() == 30_000
    assert held.count() < 30_300


def test_bits(spark):
    data = bytearray(4096)
    chosen = random.Random(3).sample(range(32_768), 200) + [0, 7, 8, 32_767]
    for k in chosen:
        data[k // 8] |= 1 << k % 8
    frame = spark.createDataFrame([(bytes(data),)], "b binary").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(32_767))))
    got = {r.k for r in frame.filter(copies.has_bit(F.col("b"), F.col("k"))).collect()}
    assert got == set(chosen)


def test_a_day_without_rows_loses_its_files(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    path = str(tmp_path / "days")
    covered = [f"2024-01-{d:02d}" for d in range(8, 15)]
    replace_days(incremental_batch(events, "2024-01-15", "ts"), path, covered=covered)
    less = events.filter("to_date(ts) <> '2024-01-10'")
    stored = replace_days(incremental_batch(less, "2024-01-15", "ts"), path, covered=covered)
    assert stored.count() == less.filter("ts >= '2024-01-08' AND ts < '2024-01-15'").count()
    assert replace_days(incremental_batch(events.limit(0), "2024-01-15", "ts"), path, covered=covered).count() == 0


def trips(spark, rows):
    return spark.createDataFrame(rows, "fecha date, lote string, pickup_cluster int, pickup_hour int, pickup_dayofweek int, "
                                       "trip_duration long, distancia_haversine_km double, passenger_count int")


def drawn(day, n, seed, keys=3):
    draw = random.Random(seed)
    value = lambda x: None if draw.random() < 0.1 else x
    return [(day, "x", value(draw.randrange(keys)), draw.randrange(2), day.isoweekday(), value(draw.randrange(5, 900)),
             value(draw.choice([0.0, -1.5, 2.5, draw.expovariate(0.2), 3 + draw.random() / 1e6])), value(draw.randrange(7))) for _ in range(n)]


def test_only_changed_keys_are_computed_and_failures_are_made_up_for(spark, tmp_path, monkeypatch):
    folder, week = str(tmp_path), [datetime.date(2024, 1, d) for d in range(8, 15)]
    rows = {day: drawn(day, 120, k) for k, day in enumerate(week)}
    asked, original = [], demand_state.merged_demand

    def seen(values, *rest):
        asked.append({r[0] for r in values.select("pickup_dayofweek").distinct().collect()})
        return original(values, *rest)

    def run(days):
        analytics = trips(spark, [r for own in rows.values() for r in own])
        analytics.write.mode("overwrite").partitionBy("fecha", "lote").parquet(f"{folder}/analytics")
        names = {str(d) for d in days}
        out = demand_state.update_demand(spark.read.schema(analytics.schema).parquet(f"{folder}/analytics"), folder, lambda p: p["fecha"] in names)
        wanted = demand_aggregate(analytics)
        assert out.exceptAll(wanted).count() == 0 and wanted.exceptAll(out).count() == 0
        return out

    monkeypatch.setattr(demand_state, "merged_demand", seen)
    run(week)
    rows[week[2]] = drawn(week[2], 90, 50, keys=2)  # keys that lose all rows, and others that change
    run(week[2:3])
    assert asked == [set(range(1, 8)), {3}]
    rows[week[4]] = []  # a weekday that is left without a row
    monkeypatch.setattr(demand_state, "merged_demand", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(week[4:5])
    monkeypatch.setattr(demand_state, "merged_demand", original)
    out = run(week[4:5])  # its old counts are gone by now, its keys are not
    assert out.filter("pickup_dayofweek = 5").count() == 0 and not (tmp_path / demand_state.PENDING).exists()
