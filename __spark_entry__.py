"""

Trips are derived from ``events`` by Spark; the generic operators also run on ``lineitem``,
``orders`` and ``customer``. Derived distances, bearings and speeds are rounded to six
decimals here, so that both engines sort and cut the same numbers.
"""

from __future__ import annotations

import os
import sys
import uuid
from importlib.util import find_spec
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle_base import BAND, CENTROIDS, CTES, SITES, eta, hav, long_sql, psi_ctes, rnd, state, with_ctes  # noqa: E402
from oracle_base import _near  # noqa: E402
from tripstrata.config import INTENSITIES, MODEL, RULE_NAMES, THRESHOLDS, TableNames  # noqa: E402
from tripstrata.functions import calendar as cal  # noqa: E402
from tripstrata.functions import geo, numeric  # noqa: E402
from tripstrata.functions.typing import apply_types, map_flag, schema_report  # noqa: E402
from tripstrata.operators import alerts as al  # noqa: E402
from tripstrata.operators import baselines as bl  # noqa: E402
from tripstrata.operators import demand as dm  # noqa: E402
from tripstrata.operators import drift as dr  # noqa: E402
from tripstrata.operators import effects as ef  # noqa: E402
from tripstrata.operators import evaluation as ev  # noqa: E402
from tripstrata.operators import models as md  # noqa: E402
from tripstrata.operators import ordering as od  # noqa: E402
from tripstrata.operators import quality as q  # noqa: E402
from tripstrata.operators import quantiles as qt  # noqa: E402
from tripstrata.operators import scenarios as sc  # noqa: E402
from tripstrata.operators import zones as zn  # noqa: E402
from tripstrata.plans import alerting, batches, bronze, eda, gold, model, monitoring, silver  # noqa: E402
from tripstrata.sources import audit, readers, writers  # noqa: E402
from tripstrata.sources.event_trips import FIRST_DAY, SPLIT_CUTOFF, raw_trips  # noqa: E402
from tripstrata.sources.staging import scratch_dir, stage_table  # noqa: E402
from tripstrata.streaming import demand_state  # noqa: E402
from tripstrata.streaming.incremental import batch_days, incremental_batch, replace_days  # noqa: E402

LIMITS = replace(THRESHOLDS, split_cutoff=SPLIT_CUTOFF)
RULES = ", ".join(RULE_NAMES)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where there is one."""
    def register(run):
        _QUERIES[name] = run
        if sql:
            _ORACLE[name] = sql
        return run

    return register


# --- Layers the queries start from ------------------------------------------

def table(spark, sf, name):
    return readers.read_table(spark, f"{sf}/{name}.parquet")


def flagged(spark, sf):
    return q.flag_rules(apply_types(raw_trips(spark, sf)), q.trip_rules(LIMITS))


def stored_flags(spark, sf):
    """The flagged rows as a staged table, laid out by validity: each side reads only its own files."""
    return stage_table(flagged(spark, sf), "flagged", partition_by="es_valido")


def clean(spark, sf):
    return q.quarantine_split(stored_flags(spark, sf))[0]


def quarantine(spark, sf):
    return q.quarantine_split(stored_flags(spark, sf))[1]


def r6(df, *columns):
    """The named columns rounded to six decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def zoned(spark, sf):
    enriched = r6(gold.enrich(clean(spark, sf), LIMITS),
                  "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg")
    return zn.zone_assign(enriched, CENTROIDS)


def analytics(spark, sf):
    return r6(gold.analytics_frame(zoned(spark, sf)), "velocidad_kmh")


def features(spark, sf):
    return q.select_whitelist(zoned(spark, sf))


def halves(df):
    return df.filter("split_flag = 'train'"), df.filter("split_flag = 'test'")


# Layers that a query reads more than once are staged first, as the pipelines do with tables.

def stored_analytics(spark, sf):
    return stage_table(analytics(spark, sf), "analytics", partition_by="split_flag")


def stored_features(spark, sf):
    return stage_table(features(spark, sf), "features", partition_by="split_flag")


def logs(spark, sf):
    return eda.with_logs(stored_analytics(spark, sf))


def scored(spark, sf):
    rows = stored_analytics(spark, sf)
    return stage_table(model.baseline_predictions(halves(rows)[0], rows), "scored", partition_by="split_flag")


def residuals(spark, sf):
    return ev.with_residual_minutes(scored(spark, sf).filter("split_flag = 'test'"), "trip_duration", "p_distancia_hora")


# --- Sources, audit, sinks ---------------------------------------------------

@query("read_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("schema_report", """
    SELECT unnest(['r_regionkey', 'r_name']) AS columna, unnest(['bigint', 'string']) AS tipo FROM (SELECT count(*) FROM region)""")
def _(spark, sf):
    return schema_report(table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name"))


def csv_copy(spark, sf, origin="train"):
    """Raw trips written as a CSV file with a header, for the strict reader."""
    path = f"{scratch_dir(spark)}/stages/csv-{uuid.uuid4().hex}"
    raw_trips(spark, sf).select(*readers.raw_columns(origin)).write.option("header", "true").csv(path)
    return path


@query("read_raw_csv", with_ctes("""
    SELECT vendor_id, count(*) AS n, count(DISTINCT id) AS n_id, min(pickup_datetime) AS primero,
           max(trip_duration) AS texto_maximo FROM raw GROUP BY vendor_id""", "raw"))
def _(spark, sf):
    raw = readers.read_raw_csv(spark, csv_copy(spark, sf), readers.raw_columns("train"))
    return raw.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_id"),
        F.min("pickup_datetime").alias("primero"), F.max("trip_duration").alias("texto_maximo"))


HASHED = "concat_ws('||', " + ", ".join(f"coalesce({c}, '<null>')" for c in readers.raw_columns("train")) + ")"


@query("with_audit", with_ctes(f"""
    SELECT id, 'train.csv' AS _source_file, 'train' AS _origen, sha256({HASHED}) AS _row_hash FROM raw""", "raw"))
def _(spark, sf):
    return bronze.bronze_frame(raw_trips(spark, sf), "train.csv").select("id", "_source_file", "_origen", "_row_hash")


@query("row_hash", """
    SELECT c_custkey, sha256(concat_ws('||', coalesce(CAST(c_custkey AS VARCHAR), '<null>'),
           coalesce(c_name, '<null>'), coalesce(c_mktsegment, '<null>'))) AS h FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", audit.row_hash(["c_custkey", "c_name", "c_mktsegment"]).alias("h"))


def with_copies(spark, sf):
    """Raw trips loaded twice for a third of the rows, and one row resent many times."""
    raw = bronze.bronze_frame(raw_trips(spark, sf), "train.csv")
    again = raw.filter("substring(id, 3) % 3 = 0")
    one = raw.filter("id = 'id7'").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_k")
    return od.union_parts(raw, again, one)


COPIES = {"copies": f"""
    SELECT *, sha256({HASHED}) AS _row_hash FROM
    (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE CAST(substr(id, 3) AS BIGINT) % 3 = 0
     UNION ALL SELECT raw.* FROM raw, range(500) WHERE id = 'id7')"""}


@query("load_check", with_ctes("""
    SELECT count(*) AS n_filas, count(DISTINCT _row_hash) AS n_hash, count(DISTINCT id) AS n_ids,
           count(*) - count(DISTINCT _row_hash) AS duplicados_exactos,
           count(*) - count(DISTINCT id) AS ids_repetidos, CAST(10000 AS BIGINT) AS filas_esperadas,
           count(*) = 10000 AS conteo_correcto FROM copies""", "raw", COPIES))
def _(spark, sf):
    return audit.load_check(with_copies(spark, sf), expected=10000)


@query("dedup_exact", with_ctes("SELECT DISTINCT id, _row_hash FROM copies", "raw", COPIES))
def _(spark, sf):
    return q.dedup_exact(with_copies(spark, sf)).select("id", "_row_hash")


def scratch_tables(spark) -> TableNames:
    """Own schemas for one run, kept under the scratch folder."""
    run = uuid.uuid4().hex[:12]
    names = TableNames(bronze=f"b_{run}", silver=f"s_{run}", gold=f"g_{run}")
    for schema in names.schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{scratch_dir(spark)}/stages/{schema}'")
    return names


@query("overwrite_table", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    name = scratch_tables(spark).clean
    nations = table(spark, sf, "nation")
    writers.overwrite_table(nations.select("n_nationkey"), name)
    return writers.overwrite_table(nations.select("n_nationkey", "n_name"), name)


@query("overwrite_partitioned", """
    SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS claves FROM orders
    GROUP BY 1""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    written = writers.overwrite_partitioned(orders, scratch_tables(spark).analytics, "o_orderstatus")
    return written.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("claves"))


@query("append_history", """
    SELECT c_mktsegment, count(*) AS n, CAST(NULL AS DOUBLE) AS saldo FROM customer GROUP BY 1
    UNION ALL SELECT c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 1""")
def _(spark, sf):
    name = scratch_tables(spark).dq_metrics
    grouped = table(spark, sf, "customer").groupBy("c_mktsegment")
    writers.append_history(grouped.agg(F.count(F.lit(1)).alias("n")), name)
    return writers.append_history(
        grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("saldo")), name)


@query("stage_table", with_ctes("SELECT es_valido, count(*) AS n FROM flagged GROUP BY 1", "flagged"))
def _(spark, sf):
    return stored_flags(spark, sf).groupBy("es_valido").agg(F.count(F.lit(1)).alias("n"))


@query("summary_json", with_ctes("""
    SELECT count(*) AS n_viajes, quantile_disc(trip_duration, 0.5)::DOUBLE AS mediana_seg,
           round(avg(trip_duration), 6) AS media_seg, round(pow(corr(log_dur, log_dist), 2), 5) AS r2 FROM logs""", "logs"))
def _(spark, sf):
    path = f"{scratch_dir(spark)}/stages/summary-{uuid.uuid4().hex}"
    writers.write_summary_json(eda.eda_summary(stored_analytics(spark, sf), "trips"), path)
    read = readers.stats_from_summary(spark, path)
    return read.select("n_viajes", "target.mediana_seg", F.round("target.media_seg", 6).alias("media_seg"),
                       F.round("r2_distancia_sola", 5).alias("r2"))


# --- Typing and quality ------------------------------------------------------

@query("apply_types", with_ctes("""
    SELECT id, vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup,
           strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff, passenger_count, pickup_longitude,
           pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration FROM typed""", "typed"))
def _(spark, sf):
    return apply_types(raw_trips(spark, sf)).select(
        "id", "vendor_id", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup"),
        F.date_format("dropoff_datetime", "yyyy-MM-dd HH:mm:ss").alias("dropoff"), "passenger_count",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "store_and_fwd_flag",
        "trip_duration")


@query("map_flag", """
    SELECT l_returnflag, CAST(CASE upper(trim(l_returnflag)) WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS INTEGER) AS codigo,
           count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", map_flag(F.col("l_returnflag")).alias("codigo")).agg(
        F.count(F.lit(1)).alias("n"))


TEXTS = ["event_id", "event_type", "props"]


def event_texts(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.when(F.col("event_id") % 10 != 0, F.regexp_replace("props", "[^0-9]", "")).alias("props"))


@query("null_counts", """
    SELECT 'event_id' AS columna, count(*) FILTER (event_id IS NULL) AS nulos FROM events
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM events
    UNION ALL SELECT 'props', count(*) FILTER (event_id % 10 = 0 OR props IS NULL) FROM events""")
def _(spark, sf):
    return q.null_counts(event_texts(spark, sf), TEXTS)


@query("cast_losses", """
    WITH t AS (SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
                      CASE WHEN event_id % 10 <> 0 THEN regexp_replace(props, '[^0-9]', '', 'g') END AS props FROM events)
    SELECT 'event_id' AS columna, count(*) FILTER (event_id IS NOT NULL AND try_cast(event_id AS BIGINT) IS NULL) AS valores_perdidos FROM t
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NOT NULL AND try_cast(event_type AS INTEGER) IS NULL) FROM t
    UNION ALL SELECT 'props', count(*) FILTER (props IS NOT NULL AND try_cast(props AS INTEGER) IS NULL) FROM t""")
def _(spark, sf):
    types = {"event_id": "bigint", "event_type": "int", "props": "int"}
    return q.cast_losses(event_texts(spark, sf), TEXTS, lambda df: apply_types(df, types))


@query("flag_rules", with_ctes(f"SELECT id, {RULES}, es_valido FROM flagged", "flagged"))
def _(spark, sf):
    return flagged(spark, sf).select("id", *RULE_NAMES, "es_valido")


@query("dq_summary", with_ctes(
    "SELECT " + ", ".join(f"count(*) FILTER (NOT {r}) AS {r}" for r in RULE_NAMES)
    + ", count(*) FILTER (NOT es_valido) AS total_invalidas, count(*) AS total_filas FROM flagged", "flagged"))
def _(spark, sf):
    return q.dq_summary(flagged(spark, sf))


DQ_SQL = " UNION ALL ".join(
    f"SELECT '{r}' AS regla, count(*) FILTER (NOT {r}) AS filas_fallidas, count(*) AS filas_evaluadas, "
    f"round(count(*) FILTER (NOT {r}) * 100.0 / count(*), 6) AS pct_fallo, 'trips' AS tabla_origen FROM flagged"
    for r in RULE_NAMES)


@query("dq_metrics", with_ctes(DQ_SQL, "flagged"))
def _(spark, sf):
    return r6(q.dq_metrics(flagged(spark, sf), "trips"), "pct_fallo").drop("evaluado_en")


@query("quarantine_split", with_ctes(f"""
    SELECT 'clean' AS lado, id, NULL AS v_duracion, trip_duration FROM clean
    UNION ALL SELECT 'quarantine', id, v_duracion, trip_duration FROM quarantine""", "quarantine"))
def _(spark, sf):
    good, bad = q.quarantine_split(stored_flags(spark, sf))
    return good.select(F.lit("clean").alias("lado"), "id", F.lit(None).cast("boolean").alias("v_duracion"),
                       "trip_duration").unionByName(
        bad.select(F.lit("quarantine").alias("lado"), "id", "v_duracion", "trip_duration"))


@query("rule_combinations", with_ctes(f"SELECT {RULES}, count(*) AS count FROM quarantine GROUP BY ALL", "quarantine"))
def _(spark, sf):
    return q.rule_combinations(quarantine(spark, sf))


@query("quarantine_sample", with_ctes(f"""
    SELECT id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime, trip_duration, passenger_count,
           pickup_latitude, pickup_longitude, {RULES} FROM quarantine ORDER BY id LIMIT 20""", "quarantine"))
def _(spark, sf):
    return q.quarantine_sample(quarantine(spark, sf)).withColumn(
        "pickup_datetime", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"))


@query("threshold_audit", with_ctes(f"""
    SELECT count(*) AS n, round(max(km / h), 6) AS velocidad_maxima_kmh,
           round(avg((km / h < 1)::INT), 6) AS prop_menor_1_kmh, round(avg((km / h < 5)::INT), 6) AS prop_menor_5_kmh,
           round(avg((h > 23)::INT), 6) AS prop_mas_23_h, round(max(h), 6) AS horas_maximas,
           round(median(h), 6) AS horas_mediana, round(median(km), 6) AS km_mediana
    FROM (SELECT trip_duration / 3600.0 AS h, {hav("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")} AS km
          FROM quarantine WHERE NOT v_duracion AND v_coords_pickup AND v_coords_dropoff)""", "quarantine"))
def _(spark, sf):
    audit_frame = q.threshold_audit(quarantine(spark, sf))
    return r6(audit_frame, *[c for c in audit_frame.columns if c != "n"])


FEATURES_SQL = ", ".join(MODEL.whitelist)


@query("select_whitelist", with_ctes(f"""
    SELECT id, {FEATURES_SQL}, trip_duration, round(ln(1 + trip_duration), 6) AS log_trip_duration, split_flag
    FROM zoned""", "zoned"))
def _(spark, sf):
    chosen = features(spark, sf)
    q.assert_no_leakage(chosen.columns)
    return r6(chosen, "log_trip_duration")


@query("conservation_check", with_ctes("""
    SELECT t.tabla, t.filas, 0::BIGINT AS filas_con_nulos FROM (
      SELECT 'entrada' AS tabla, count(*) AS filas FROM flagged UNION ALL SELECT 'clean', count(*) FROM clean
      UNION ALL SELECT 'quarantine', count(*) FROM quarantine) t""", "zoned"))
def _(spark, sf):
    rows = stored_flags(spark, sf)
    good, bad = q.quarantine_split(rows)
    checked = q.select_whitelist(zn.zone_assign(gold.enrich(good, LIMITS), CENTROIDS))
    return q.conservation_check(rows, {"clean": good, "quarantine": bad}, checked)


# --- Column functions --------------------------------------------------------

@query("temporal_features", with_ctes(
    "SELECT id, pickup_hour, pickup_dayofweek, pickup_month, is_weekend FROM enriched", "enriched"))
def _(spark, sf):
    return cal.temporal_features(clean(spark, sf)).select(
        "id", "pickup_hour", "pickup_dayofweek", "pickup_month", "is_weekend")


@query("geo_features", with_ctes(
    "SELECT id, distancia_haversine_km, distancia_manhattan_km, bearing_deg FROM enriched", "enriched"))
def _(spark, sf):
    return r6(geo.geo_features(clean(spark, sf)), "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg").select(
        "id", "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg")


@query("near_any", with_ctes("SELECT id, es_aeropuerto FROM enriched", "enriched"))
def _(spark, sf):
    return clean(spark, sf).select("id", geo.near_any().alias("es_aeropuerto"))


@query("speed_and_minutes", with_ctes(
    "SELECT id, velocidad_kmh, round(duracion_min, 6) AS duracion_min FROM analytics", "analytics"))
def _(spark, sf):
    return r6(analytics(spark, sf), "duracion_min").select("id", "velocidad_kmh", "duracion_min")


@query("log_target", with_ctes("""
    SELECT id, round(ln(1 + trip_duration), 6) AS y, round(exp(ln(1 + trip_duration)) - 1, 6) AS inversa FROM clean""", "clean"))
def _(spark, sf):
    rows = clean(spark, sf).withColumn("y", numeric.log_target(F.col("trip_duration")))
    return rows.select("id", F.round("y", 6).alias("y"), F.round(numeric.inverse_log_target(F.col("y")), 6).alias("inversa"))


@query("clip", """
    SELECT l_orderkey, l_linenumber, greatest(1.0, least(21600.0, l_extendedprice)) AS recortado FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numeric.clip(F.col("l_extendedprice")).alias("recortado"))


@query("bucket_right_closed", with_ctes(
    f"SELECT CAST({BAND} AS INTEGER) AS tramo, count(*) AS n FROM analytics GROUP BY 1", "analytics"))
def _(spark, sf):
    return analytics(spark, sf).groupBy(
        numeric.bucket_right_closed(F.col("distancia_haversine_km")).alias("tramo")).agg(F.count(F.lit(1)).alias("n"))


@query("temporal_split", """
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1996-01-01' THEN 'test' ELSE 'train' END AS split_flag
    FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", cal.temporal_split("o_orderdate", "1996-01-01").alias("split_flag"))


@query("category_codes", """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS codigo FROM orders""")
def _(spark, sf):
    return numeric.category_codes(table(spark, sf, "orders"), "o_orderpriority", "codigo").select("o_orderkey", "codigo")


WINDOWS = cal.forward_windows(FIRST_DAY, SPLIT_CUTOFF, 3)


@query("forward_windows", with_ctes(" UNION ALL ".join(f"""
    SELECT CAST({w['ventana']} AS INTEGER) AS ventana, '{w['entrena_hasta']}' AS corte,
           CASE WHEN pickup_datetime < TIMESTAMP '{w['entrena_hasta']}' THEN 'train' ELSE 'valid' END AS papel, count(*) AS n
    FROM train WHERE pickup_datetime < TIMESTAMP '{w['valida_hasta']}' GROUP BY ALL""" for w in WINDOWS), "train"))
def _(spark, sf):
    train = halves(analytics(spark, sf))[0]
    cuts = cal.forward_windows_frame(spark, FIRST_DAY, SPLIT_CUTOFF, 3).select("ventana", F.col("entrena_hasta").alias("corte"))
    # One row per window.
    return cal.forward_split(train, WINDOWS).groupBy("ventana", "papel").agg(F.count(F.lit(1)).alias("n")).join(
        F.broadcast(cuts), "ventana").select("ventana", "corte", "papel", "n")


# --- Aggregation and effects -------------------------------------------------

@query("split_share", with_ctes("""
    SELECT split_flag, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM enriched GROUP BY 1""",
    "enriched"))
def _(spark, sf):
    return r6(dm.split_share(gold.enrich(clean(spark, sf), LIMITS)), "pct")


@query("demand_aggregate", with_ctes("SELECT * FROM demand", "demand"))
def _(spark, sf):
    return dm.demand_aggregate(zoned(spark, sf))


@query("hour_profile", with_ctes(
    "SELECT pickup_hour, viajes, round(vel, 6) AS vel, round(dur, 6) AS dur FROM profile", "profile"))
def _(spark, sf):
    return r6(dm.hour_profile(dm.demand_aggregate(zoned(spark, sf))), "vel", "dur")


@query("slow_fast_hour", with_ctes("""
    SELECT l.pickup_hour AS hora_lenta, round(l.vel, 6) AS vel_lenta, r.pickup_hour AS hora_rapida,
           round(r.vel, 6) AS vel_rapida, round(r.vel / l.vel, 6) AS razon
    FROM (SELECT * FROM profile ORDER BY vel, pickup_hour LIMIT 1) l,
         (SELECT * FROM profile ORDER BY vel DESC, pickup_hour LIMIT 1) r""", "profile"))
def _(spark, sf):
    return r6(dm.slow_fast_hour(dm.hour_profile(dm.demand_aggregate(zoned(spark, sf)))), "vel_lenta", "vel_rapida", "razon")


def shape_sql(x):
    m = f"(SELECT avg({x}) FROM logs)"
    m2, m3, m4 = (f"avg(pow({x} - {m}, {k}))" for k in (2, 3, 4))
    return f"round({m3} / pow({m2}, 1.5), 6)", f"round({m4} / pow({m2}, 2) - 3, 6)"


SKEW, KURT = shape_sql("trip_duration")
SKEW_LOG, KURT_LOG = shape_sql("log_dur")


@query("distribution_shape", with_ctes(f"""
    SELECT round(avg(trip_duration) / 60, 6) AS media_min, round(quantile_disc(trip_duration, 0.5) / 60.0, 6) AS mediana_min,
           round(quantile_disc(trip_duration, 0.9) / 60.0, 6) AS p90_min, {SKEW} AS asimetria, {KURT} AS curtosis,
           {SKEW_LOG} AS asimetria_log, {KURT_LOG} AS curtosis_log FROM logs""", "logs"))
def _(spark, sf):
    shape = ef.distribution_shape(stored_analytics(spark, sf), "trip_duration")
    return r6(shape, *shape.columns)


@query("quantile_linear", """
    SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
           round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90
    FROM lineitem GROUP BY 1""")
def _(spark, sf):
    found = qt.quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.9], ["p10", "p50", "p90"])
    return r6(found, "p10", "p50", "p90")


@query("quantile_linear_discrete", """
    SELECT l_suppkey, count(*) AS n, round(quantile_cont(l_quantity, 0.25), 6) AS p25,
           round(quantile_cont(l_quantity, 0.75), 6) AS p75 FROM lineitem GROUP BY 1""")
def _(spark, sf):
    found = qt.quantiles(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", [0.25, 0.75], ["p25", "p75"], "discrete")
    return r6(found, "p25", "p75")


@query("band_dispersion", with_ctes("""
    SELECT CASE tramo WHEN 0 THEN '0-1 km' WHEN 1 THEN '1-2 km' WHEN 2 THEN '2-3 km' WHEN 3 THEN '3-5 km'
                WHEN 4 THEN '5-8 km' WHEN 5 THEN '8-12 km' WHEN 6 THEN '12-20 km' ELSE '20-100 km' END AS tramo,
           count(*) AS n, round(quantile_cont(trip_duration, 0.1) / 60, 6) AS p10,
           round(quantile_cont(trip_duration, 0.5) / 60, 6) AS p50, round(quantile_cont(trip_duration, 0.9) / 60, 6) AS p90,
           round((quantile_cont(trip_duration, 0.9) - quantile_cont(trip_duration, 0.1)) / 60, 6) AS ancho,
           round(quantile_cont(trip_duration, 0.9) / quantile_cont(trip_duration, 0.1), 6) AS razon
    FROM everything WHERE tramo IS NOT NULL AND distancia_haversine_km <= 100 GROUP BY 1 HAVING count(*) >= 100""", "everything"))
def _(spark, sf):
    return r6(ef.band_dispersion(stored_analytics(spark, sf), "distancia_haversine_km", "trip_duration"),
              "p10", "p50", "p90", "ancho", "razon")


@query("eta_squared", f"SELECT 'l_returnflag' AS factor, round({eta('lineitem', 'l_returnflag', 'l_extendedprice')}, 9) AS eta2")
def _(spark, sf):
    return ef.eta_squared(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag").withColumn("eta2", F.round("eta2", 9))


@query("simple_regression", """
    SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercepto,
           round(regr_slope(l_extendedprice, l_quantity), 4) AS pendiente,
           round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def _(spark, sf):
    return ef.simple_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        F.round("intercepto", 4).alias("intercepto"), F.round("pendiente", 4).alias("pendiente"), F.round("r2", 6).alias("r2"))


@query("with_residual", with_ctes("SELECT id, round(residuo, 6) AS residuo FROM residual", "residual"))
def _(spark, sf):
    return r6(ef.with_residual(logs(spark, sf), "log_dist", "log_dur"), "residuo").select("id", "residuo")


@query("effect_table", with_ctes(" UNION ALL ".join(
    f"SELECT '{f}' AS factor, round({eta('residual', f, 'log_dur')}, 6) AS eta2_marginal, "
    f"round({eta('residual', f, 'residuo')}, 6) AS eta2_parcial" for f in MODEL.effect_factors), "residual"))
def _(spark, sf):
    rows = ef.with_residual(logs(spark, sf), "log_dist", "log_dur")
    return ef.effect_table(rows, "log_dur", "residuo", MODEL.effect_factors)


@query("effect_table_lineitem", " UNION ALL ".join(
    f"SELECT '{f}' AS factor, round({eta('lineitem', f, 'l_extendedprice')}, 6) AS eta2_marginal, "
    f"round({eta('lineitem', f, 'l_discount')}, 6) AS eta2_parcial" for f in ("l_returnflag", "l_linestatus", "l_suppkey")))
def _(spark, sf):
    return ef.effect_table(table(spark, sf, "lineitem"), "l_extendedprice", "l_discount", ["l_returnflag", "l_linestatus", "l_suppkey"])


DAILY_SQL = "SELECT CAST(fecha AS VARCHAR) AS fecha, viajes, vel FROM daily"


def dated(df, column="fecha"):
    return df.withColumn(column, F.col(column).cast("string"))


def daily(spark, sf):
    return stage_table(dm.daily_series(analytics(spark, sf)), "daily")


@query("daily_series", with_ctes(DAILY_SQL, "daily"))
def _(spark, sf):
    return dated(daily(spark, sf))


@query("daily_orders", """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha, count(*) AS viajes,
           quantile_disc(o_totalprice, 0.5) AS vel FROM orders GROUP BY 1""")
def _(spark, sf):
    return dated(dm.daily_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))


@query("moving_average", with_ctes("""
    SELECT CAST(fecha AS VARCHAR) AS fecha, viajes, round(CASE WHEN count(*) OVER w = 7 THEN avg(viajes) OVER w END, 6) AS media_movil
    FROM daily WINDOW w AS (ORDER BY fecha ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""", "daily"))
def _(spark, sf):
    return r6(dated(dm.moving_average(daily(spark, sf))), "media_movil").drop("vel")


@query("weekday_variance_share", with_ctes("""
    SELECT round(var_samp(m) / var_samp(viajes), 6) AS prop_varianza_dia_semana
    FROM (SELECT viajes, avg(viajes) OVER (PARTITION BY dayofweek(fecha)) AS m FROM daily)""", "daily"))
def _(spark, sf):
    return r6(dm.weekday_variance_share(daily(spark, sf)), "prop_varianza_dia_semana")


@query("extreme_day", with_ctes("""
    SELECT count(*) AS dias, median(viajes) AS mediana_diaria,
           CAST(arg_min(fecha, (viajes, fecha)) AS VARCHAR) AS dia_minimo,
           min(viajes) AS viajes_minimo, round(min(viajes) * 100.0 / median(viajes), 6) AS pct_de_la_mediana
    FROM daily""", "daily"))
def _(spark, sf):
    return r6(dated(dm.extreme_day(daily(spark, sf)), "dia_minimo"), "pct_de_la_mediana")


ZONES_SQL = {"zonas": "SELECT pickup_cluster, CAST(sum(n_viajes) AS BIGINT) AS viajes FROM demand GROUP BY 1"}


def demand(spark, sf):
    return dm.demand_aggregate(zoned(spark, sf))


@query("zone_concentration", with_ctes("""
    SELECT pickup_cluster, viajes, round(sum(viajes) OVER (ORDER BY viajes DESC, pickup_cluster) * 100.0 / sum(viajes) OVER (), 6) AS pct_acum
    FROM zonas""", "demand", ZONES_SQL))
def _(spark, sf):
    return r6(dm.zone_concentration(demand(spark, sf)), "pct_acum")


@query("top_share", with_ctes("""
    SELECT round((SELECT sum(viajes) FROM (SELECT viajes FROM zonas ORDER BY viajes DESC LIMIT 3)) * 100.0 / sum(viajes), 6)
           AS pct_principales FROM zonas""", "demand", ZONES_SQL))
def _(spark, sf):
    return r6(dm.top_share(dm.zone_concentration(demand(spark, sf))), "pct_principales")


@query("cumulative_share", """
    SELECT o_custkey, n, round(sum(n) OVER (ORDER BY n DESC, o_custkey ROWS UNBOUNDED PRECEDING) * 100.0 / sum(n) OVER (), 6) AS pct_acum
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""")
def _(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return r6(dm.cumulative_share(counts, "o_custkey", "n", keys_bounded=False), "pct_acum")


@query("od_pairs_topk", with_ctes("""
    SELECT pickup_cluster, dropoff_cluster, count(*) AS count FROM zoned GROUP BY 1, 2
    ORDER BY count DESC, pickup_cluster, dropoff_cluster LIMIT 10""", "zoned"))
def _(spark, sf):
    return dm.od_pairs_topk(zoned(spark, sf))


@query("intra_zone_share", with_ctes(
    "SELECT round(avg((pickup_cluster = dropoff_cluster)::INT), 6) AS prop_intrazona FROM zoned", "zoned"))
def _(spark, sf):
    return r6(dm.intra_zone_share(zoned(spark, sf)), "prop_intrazona")


@query("regime_profile", with_ctes("""
    SELECT CAST(es_aeropuerto AS VARCHAR) AS grupo, count(*) AS n, round(median(duracion_min), 4) AS mediana_duracion_min,
           round(median(distancia_haversine_km), 4) AS mediana_distancia_haversine_km,
           round(median(velocidad_kmh), 4) AS mediana_velocidad_kmh FROM analytics GROUP BY 1""", "analytics"))
def _(spark, sf):
    profile = dm.regime_profile(stored_analytics(spark, sf))
    return profile.select("grupo", "n", *[F.round(c, 4).alias(c) for c in profile.columns if c.startswith("mediana_")])


@query("site_profile", with_ctes(" UNION ALL ".join(f"""
    SELECT '{name}' AS sitio, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM analytics), 6) AS pct,
           round(median(trip_duration) / 60, 6) AS mediana_min FROM analytics WHERE {_near(place)}"""
    for name, place in SITES.items()), "analytics"))
def _(spark, sf):
    return r6(dm.site_profile(stored_analytics(spark, sf)), "pct", "mediana_min")


@query("pearson", with_ctes(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM logs" for a, b in eda.CORRELATED), "logs"))
def _(spark, sf):
    return r6(ef.pearson(logs(spark, sf), eda.CORRELATED), "r")


# --- Joins, ordering, sampling -----------------------------------------------

@query("zone_assign", with_ctes("SELECT id, pickup_cluster, dropoff_cluster FROM zoned", "zoned"))
def _(spark, sf):
    return zoned(spark, sf).select("id", "pickup_cluster", "dropoff_cluster")


@query("attach_dates", with_ctes("""
    SELECT z.id, CAST(CAST(r.pickup_datetime AS DATE) AS VARCHAR) AS fecha FROM zoned z LEFT JOIN typed r USING (id)""", "zoned"))
def _(spark, sf):
    return dated(bl.attach_dates(features(spark, sf), analytics(spark, sf)).select("id", "fecha"))


@query("lookup_predict", """
    WITH m AS (SELECT l_suppkey, median(l_quantity) AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' GROUP BY 1),
         g AS (SELECT median(l_quantity) AS g FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
    SELECT l_orderkey, l_linenumber, coalesce(m, g) AS pred FROM lineitem CROSS JOIN g LEFT JOIN m USING (l_suppkey)
    WHERE l_shipdate >= TIMESTAMP '1996-01-01'""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    fitted = bl.group_median_model(lines.filter(F.col("l_shipdate") < cut), ["l_suppkey"], "l_quantity")
    return bl.lookup_predict(lines.filter(F.col("l_shipdate") >= cut), fitted, ["l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "pred")


@query("group_median_model", with_ctes("SELECT tramo, pickup_hour, m AS mediana, g AS mediana_global FROM dis, overall", "overall"))
def _(spark, sf):
    train = halves(analytics(spark, sf))[0].withColumn("tramo", numeric.bucket_right_closed(F.col("distancia_haversine_km")))
    medians, overall = bl.group_median_model(train, bl.DISTANCE_KEYS)
    return medians.withColumn("mediana_global", overall.scalar())


@query("rank_compare", """
    WITH e AS (SELECT c_nationkey, row_number() OVER (ORDER BY count(*) DESC, c_nationkey) AS prevista FROM customer GROUP BY 1),
         o AS (SELECT s_nationkey, row_number() OVER (ORDER BY count(*) DESC, s_nationkey) AS obtenida FROM supplier GROUP BY 1)
    SELECT c_nationkey AS factor, prevista, obtenida FROM e JOIN o ON s_nationkey = c_nationkey""")
def _(spark, sf):
    return od.rank_compare(*_nation_ranks(spark, sf))


def _nation_ranks(spark, sf):
    def ranked(name, column):
        counts = table(spark, sf, name).groupBy(F.col(column).alias("factor")).agg(F.count(F.lit(1)).alias("n"))
        return od.positions(counts, "factor", "n")

    return ranked("customer", "c_nationkey"), ranked("supplier", "s_nationkey")


@query("rank_agreement", """
    WITH e AS (SELECT c_nationkey, row_number() OVER (ORDER BY count(*) DESC, c_nationkey) AS prevista FROM customer GROUP BY 1),
         o AS (SELECT s_nationkey, row_number() OVER (ORDER BY count(*) DESC, s_nationkey) AS obtenida FROM supplier GROUP BY 1)
    SELECT round(corr(prevista, obtenida), 6) AS concordancia FROM e JOIN o ON s_nationkey = c_nationkey""")
def _(spark, sf):
    return r6(od.rank_agreement(od.rank_compare(*_nation_ranks(spark, sf))), "concordancia")


@query("union_parts", """
    SELECT 'c' AS parte, c_custkey AS clave, c_acctbal AS saldo FROM customer
    UNION ALL SELECT 's', s_suppkey, s_acctbal FROM supplier""")
def _(spark, sf):
    customers = table(spark, sf, "customer").select(F.lit("c").alias("parte"), F.col("c_custkey").alias("clave"), F.col("c_acctbal").alias("saldo"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("saldo"), F.lit("s").alias("parte"), F.col("s_suppkey").alias("clave"))
    return od.union_parts(customers, suppliers)


def share_sql(key, salt=""):
    return f"(CAST('0x' || substr(sha256({key} || '{salt}'), 1, 8) AS BIGINT) / 4294967296.0)"


@query("sample_by_key", f"""
    SELECT o_orderkey, o_totalprice FROM orders WHERE {share_sql("CAST(o_orderkey AS VARCHAR)", "s42")} < 0.2""")
def _(spark, sf):
    return od.sample_by_key(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.2, "s42")


@query("sample_fraction", """
    SELECT count(*) AS n_tabla, true AS sin_repetidos, true AS de_la_tabla, true AS cantidad_esperada FROM orders""")
def _(spark, sf):
    """A sample differs from run to run of another layout: what must hold is that it is one, of about the size asked for."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    drawn = stage_table(od.sample_fraction(orders, 0.4, 42), "sample")
    facts = drawn.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("d"))
    known = drawn.join(orders, "o_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("k")).scalar()
    return orders.agg(F.count(F.lit(1)).alias("n_tabla")).withColumn("f", facts.select(F.struct("n", "d")).scalar()).select(
        "n_tabla", (F.col("f.n") == F.col("f.d")).alias("sin_repetidos"), (F.col("f.n") == known).alias("de_la_tabla"),
        (F.abs(F.col("f.n") - 0.4 * F.col("n_tabla")) <= 5 * F.sqrt(0.24 * F.col("n_tabla"))).alias("cantidad_esperada"))


# --- Evaluation --------------------------------------------------------------

def metrics_sql(pred, name, where="split_flag = 'test'"):
    return f"""SELECT '{name}' AS modelo, sqrt(avg(pow({pred} - trip_duration, 2))) / 60 AS rmse_min,
        avg(abs({pred} - trip_duration)) / 60 AS mae_min,
        1 - avg(pow({pred} - trip_duration, 2)) / var_pop(trip_duration) AS r2,
        sqrt(avg(pow(ln(1 + {pred}) - ln(1 + trip_duration), 2))) AS rmsle FROM scored WHERE {where}"""


NAMES = {model.CALENDAR: "p_calendario", model.DISTANCE_HOUR: "p_distancia_hora"}
METRICS_SQL = " UNION ALL ".join(metrics_sql(p, n) for n, p in NAMES.items())
METRICS = ("rmse_min", "mae_min", "r2", "rmsle")
ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)


def test_metrics(spark, sf):
    on_test = scored(spark, sf).filter("split_flag = 'test'")
    return ev.regression_metrics(ev.predictions_long(on_test, "trip_duration", NAMES), "trip_duration", "pred")


@query("calendar_baseline", with_ctes("SELECT id, p_calendario AS pred FROM scored WHERE split_flag = 'test'", "scored"))
def _(spark, sf):
    train, test = halves(stored_analytics(spark, sf))
    return bl.calendar_baseline(train, test).select("id", "pred")


@query("distance_hour_baseline", with_ctes("SELECT id, p_distancia_hora AS pred FROM scored WHERE split_flag = 'test'", "scored"))
def _(spark, sf):
    train, test = halves(stored_analytics(spark, sf))
    return bl.distance_hour_baseline(train, test).select("id", "pred")


@query("regression_metrics", with_ctes(f"SELECT modelo, {ROUNDED} FROM mm", "scored", {"mm": METRICS_SQL}))
def _(spark, sf):
    return r6(test_metrics(spark, sf), *METRICS)


@query("business_reading", with_ctes(f"""
    SELECT {rnd("mae / 60", 2)} AS error_medio_min, {rnd("m / 60", 2)} AS viaje_mediano_min,
           {rnd("mae / m * 100", 1)} AS error_relativo_pct, {rnd("greatest(0.0, m / 60 - mae / 60)", 1)} AS ventana_min,
           {rnd("m / 60 + mae / 60", 1)} AS ventana_max
    FROM (SELECT avg(abs(p_distancia_hora - trip_duration)) AS mae, median(trip_duration) AS m FROM scored WHERE split_flag = 'test')""",
    "scored"))
def _(spark, sf):
    return ev.business_reading(scored(spark, sf).filter("split_flag = 'test'"), "trip_duration", "p_distancia_hora")


@query("overfit_gap", with_ctes(" UNION ALL ".join(f"""
    SELECT '{m}' AS metrica, {rnd("a." + m, 4)} AS train, {rnd("b." + m, 4)} AS test,
           {rnd(f"b.{m} - a.{m}", 4)} AS brecha_absoluta, {rnd(f"(b.{m} - a.{m}) / a.{m} * 100", 1)} AS brecha_relativa_pct
    FROM a, b""" for m in ("rmse_min", "mae_min", "rmsle")), "scored", {
        "a": metrics_sql("p_distancia_hora", "x", "split_flag = 'train'"),
        "b": metrics_sql("p_distancia_hora", "x")}))
def _(spark, sf):
    return ev.overfit_gap(ev.regression_metrics(scored(spark, sf), "trip_duration", "p_distancia_hora", by=["split_flag"]))


@query("model_comparison", with_ctes(f"""
    SELECT modelo, {ROUNDED}, round((1 - rmsle / (SELECT min(rmsle) FROM mm)) * 100, 3) AS mejora_pct FROM mm""",
    "scored", {"mm": METRICS_SQL}))
def _(spark, sf):
    return r6(ev.model_comparison(test_metrics(spark, sf), list(NAMES)), *METRICS).withColumn(
        "mejora_pct", F.round("mejora_pct", 3))


@query("residual_summary", with_ctes("""
    SELECT count(*) AS n, round(avg(residuo_min), 6) AS media, round(stddev_samp(residuo_min), 6) AS desv_est,
           round(skewness(residuo_min), 6) AS asimetria, round(median(residuo_min), 6) AS mediana FROM res""", "res"))
def _(spark, sf):
    return r6(ev.residual_summary(residuals(spark, sf)), "media", "desv_est", "asimetria", "mediana")


@query("residual_by_segment", with_ctes(" UNION ALL ".join(f"""
    SELECT '{s}' AS segmento, CAST({s} AS VARCHAR) AS nivel, count(*) AS n, round(median(residuo_min), 6) AS residuo_mediano
    FROM res GROUP BY 2""" for s in ("pickup_hour", "es_aeropuerto")), "res"))
def _(spark, sf):
    return r6(ev.residual_by_segment(residuals(spark, sf), ["pickup_hour", "es_aeropuerto"]), "residuo_mediano")


@query("residual_by_band", with_ctes("""
    SELECT CASE WHEN distancia_haversine_km <= 2 THEN '0-2 km' WHEN distancia_haversine_km <= 5 THEN '2-5 km'
                WHEN distancia_haversine_km <= 10 THEN '5-10 km' WHEN distancia_haversine_km <= 20 THEN '10-20 km'
                ELSE '20-100 km' END AS tramo, count(*) AS n, round(median(abs(residuo_min)), 6) AS error_abs_mediano,
           round(median(residuo_min), 6) AS sesgo_mediano
    FROM res WHERE distancia_haversine_km > 0 AND distancia_haversine_km <= 100 GROUP BY 1 HAVING count(*) > 50""", "res"))
def _(spark, sf):
    return r6(ev.residual_by_band(residuals(spark, sf)), "error_abs_mediano", "sesgo_mediano")


@query("tail_contribution", with_ctes("""
    SELECT count(*) FILTER (residuo_min < -5) AS n_cola, round(avg((residuo_min < -5)::INT) * 100, 6) AS pct_cola,
           round(coalesce(sum(pow(residuo_min, 2)) FILTER (residuo_min < -5), 0) / sum(pow(residuo_min, 2)) * 100, 6) AS pct_error_cuadratico,
           round(median(trip_duration) FILTER (residuo_min < -5) / 60.0, 6) AS real_mediana_cola_min,
           round(median(trip_duration) FILTER (residuo_min >= -5) / 60.0, 6) AS real_mediana_resto_min FROM res""", "res"))
def _(spark, sf):
    tail = ev.tail_contribution(residuals(spark, sf), "trip_duration", minutes=5.0)
    return r6(tail, *[c for c in tail.columns if c != "n_cola"])


@query("over_limit_report", with_ctes("""
    SELECT round(max(p_distancia_hora) / 3600.0, 6) AS pred_max_horas, count(*) FILTER (p_distancia_hora > 2400) AS n_sobre_limite,
           round(max(trip_duration) / 3600.0, 6) AS real_max_horas FROM scored WHERE split_flag = 'test'""", "scored"))
def _(spark, sf):
    report = ev.over_limit_report(scored(spark, sf).filter("split_flag = 'test'"), "trip_duration", "p_distancia_hora", 2400)
    return r6(report, "pred_max_horas", "real_max_horas")


# --- Models ------------------------------------------------------------------

LIGHT = md.BoostingParams(None, 10, 0.3)


@query("fit_zones", with_ctes("""
    SELECT count(*) AS n_entrenamiento, 20 AS n_zonas, true AS dentro, true AS cercanas FROM enriched WHERE split_flag = 'train'""", "enriched"))
def _(spark, sf):
    """Fitted centres differ in their last digits: every training row has a zone, and rows lie nearer to it than to the mean of all."""
    rows = stage_table(gold.enrich(clean(spark, sf), LIMITS), "enriched").filter("split_flag = 'train'")
    centres = zn.centroids_of(zn.fit_zones(rows))
    lat, lon = F.col("pickup_latitude"), F.col("pickup_longitude")
    table_of = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in centres])
    own = F.get(table_of, F.col("pickup_cluster"))
    near = F.pow(lat - F.get(own, 0), 2) + F.pow(lon - F.get(own, 1), 2)
    inside = F.lit(all(THRESHOLDS.lat_min <= a <= THRESHOLDS.lat_max and THRESHOLDS.lon_min <= b <= THRESHOLDS.lon_max
                       for a, b in centres))
    return zn.zone_assign(rows, centres).agg(
        F.count("pickup_cluster").alias("n_entrenamiento"), F.lit(len(centres)).alias("n_zonas"), inside.alias("dentro"),
        (F.avg(near) < (F.var_pop(lat) + F.var_pop(lon)) / 4).alias("cercanas"))


# Fitted trees and weights are not SQL. What SQL can say: the rows of each split, that predictions are in range, and
# that the error on the log scale is below that of the best constant.
FACTS = with_ctes("SELECT split_flag, count(*) AS n, true AS en_rango, true AS supera_constante FROM enriched GROUP BY 1", "enriched")


def facts(rows, pred="pred", real="trip_duration"):
    low, high = THRESHOLDS.duration_min_s, THRESHOLDS.duration_max_s
    miss = F.log1p(F.col(pred)) - F.log1p(F.col(real))
    return rows.groupBy("split_flag").agg(
        F.count(pred).alias("n"), ((F.min(pred) >= low) & (F.max(pred) <= high)).alias("en_rango"),
        (F.avg(miss * miss) < F.var_pop(F.log1p(real))).alias("supera_constante"))


@query("ridge_pipeline", FACTS)
def _(spark, sf):
    rows = stored_features(spark, sf)
    return facts(md.predict(md.fit_ridge(halves(rows)[0]), rows))


@query("gbt_pipeline", FACTS)
def _(spark, sf):
    rows = stored_features(spark, sf)
    return facts(md.predict(md.fit_gbt(halves(rows)[0], LIGHT), rows))


def search_sql(columns: str) -> str:
    """Per configuration the rows that its windows validate on, and the mean error of the best constants."""
    parts = " UNION ALL ".join(f"""
        SELECT count(*) AS n, sqrt(avg(pow(ln(1 + trip_duration) - (SELECT avg(ln(1 + trip_duration)) FROM train
               WHERE pickup_datetime < '{w["entrena_hasta"]}'), 2))) AS e
        FROM train WHERE pickup_datetime >= '{w["entrena_hasta"]}' AND pickup_datetime < '{w["valida_hasta"]}'""" for w in WINDOWS)
    grid = ", ".join(f"({p.max_depth or 'NULL'}, {p.max_iter}, CAST({p.learning_rate} AS DOUBLE))" for p in md.GRID)
    return (f"SELECT max_depth, max_iter, learning_rate, {columns} FROM (VALUES {grid}) v(max_depth, max_iter, learning_rate), "
            f"(SELECT count(*) AS n_ventanas, CAST(sum(n) AS BIGINT) AS filas_validadas, avg(e) AS constante FROM ({parts}))")


@query("forward_search", with_ctes(search_sql("n_ventanas, filas_validadas, round(constante, 6) AS constante, true AS la_mitad"), "train"))
def _(spark, sf):
    """The whole grid: twelve fits of up to 300 trees. ``la_mitad``: the error is at most half that of the best constants."""
    rows = stored_analytics(spark, sf)
    train = rows.filter("split_flag = 'train'").select(
        *MODEL.ordered, MODEL.target, F.log1p(MODEL.target).alias(MODEL.target_log), F.to_date("pickup_datetime").alias("fecha"))
    found = md.forward_search(train, WINDOWS)[1]
    day, real = F.col("fecha"), F.col(MODEL.target_log)
    constants = [train.filter(day.between(w["entrena_hasta"], F.date_sub(F.lit(w["valida_hasta"]).cast("date"), 1))).agg(F.sqrt(F.avg(F.pow(
        real - train.filter(day < w["entrena_hasta"]).agg(F.avg(MODEL.target_log)).scalar(), 2)))).scalar() for w in WINDOWS]
    mean = found.withColumn("constante", sum(constants, F.lit(0.0)) / len(WINDOWS))
    return r6(mean.select(
        "max_depth", "max_iter", "learning_rate", F.size("rmsle_por_ventana").cast("long").alias("n_ventanas"),
        F.aggregate("filas_por_ventana", F.lit(0).cast("long"), lambda a, n: a + n).alias("filas_validadas"), "constante",
        (F.col("rmsle_promedio") < F.col("constante") / 2).alias("la_mitad")), "constante")


@query("final_fit_predict", FACTS)
def _(spark, sf):
    train, test = halves(stored_features(spark, sf))
    return facts(md.final_fit_predict(train, test, LIGHT)[1])


@query("permutation_importance", "SELECT variable, true AS en_rango, n_eventos FROM (SELECT unnest(["
       + ", ".join(f"'{c}'" for c in MODEL.ordered) + "]) AS variable), (SELECT count(*) AS n_eventos FROM events)")
def _(spark, sf):
    train, test = halves(stored_features(spark, sf))
    found = md.permutation_importance(md.fit_gbt(train, LIGHT), test)
    return found.select("variable", (F.col("importancia").between(-1, 4) & (F.col("desviacion") >= 0)).alias("en_rango"),
                        table(spark, sf, "events").agg(F.count(F.lit(1))).scalar().alias("n_eventos"))


@query("run_log", with_ctes(f"""
    SELECT modelo, CASE modelo WHEN '{model.CALENDAR}' THEN 'mediana por hora y dia' ELSE 'mediana por tramo y hora' END AS tipo, round(rmsle, 6) AS rmsle
    FROM mm""", "scored", {"mm": METRICS_SQL}))
def _(spark, sf):
    params = {model.CALENDAR: {"tipo": "mediana por hora y dia"}, model.DISTANCE_HOUR: {"tipo": "mediana por tramo y hora"}}
    rows = writers.append_history(md.run_log(test_metrics(spark, sf), params), scratch_tables(spark).model_runs)
    return rows.select("modelo", F.col("parametros.tipo").alias("tipo"), F.round("metricas.rmsle", 6).alias("rmsle"))


# --- Drift and alerts --------------------------------------------------------

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
LINE_CUT = "TIMESTAMP '1996-01-01'"
LINE_PSI = psi_ctes(long_sql("lineitem", LINE_COLUMNS, f"l_shipdate < {LINE_CUT}"),
                    long_sql("lineitem", LINE_COLUMNS, f"l_shipdate >= {LINE_CUT}"))
TRIP_PSI = psi_ctes(long_sql("train", MODEL.monitored), long_sql("test", MODEL.monitored))


def psi_sql(ctes, sql):
    return "WITH " + ", ".join(f"{n} AS ({body})" for n, body in ctes.items()) + " " + sql


def line_halves(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_COLUMNS, "l_shipdate")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    return lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)


@query("quantile_cuts", psi_sql(LINE_PSI, "SELECT variable, unnest(c) AS corte FROM cuts"))
def _(spark, sf):
    return dr.reference_cuts(line_halves(spark, sf)[0], LINE_COLUMNS).select("variable", F.explode("cortes").alias("corte"))


@query("histogram_share", psi_sql(LINE_PSI, """
    SELECT variable, CAST(bin AS INTEGER) AS bin, n, round(n / total, 9) AS proporcion
    FROM (SELECT variable, bin, w AS n, sum(w) OVER (PARTITION BY variable) AS total FROM binned WHERE w > 0)
    WHERE bin IS NOT NULL"""))
def _(spark, sf):
    reference, batch = line_halves(spark, sf)
    cuts = dr.reference_cuts(reference, LINE_COLUMNS)
    return dr.histogram_share(batch, LINE_COLUMNS, cuts).withColumn("proporcion", F.round("proporcion", 9))


PSI_ROW = f"SELECT variable, round(psi, 6) AS psi, {state('psi')} AS estado, n_referencia, n_lote FROM psi"


@query("psi", psi_sql(LINE_PSI, PSI_ROW))
def _(spark, sf):
    found = dr.psi_by_variable(*line_halves(spark, sf), LINE_COLUMNS)
    return r6(found.withColumn("estado", dr.classify_psi(F.col("psi"))), "psi")


@query("drift_report", with_ctes(f"""
    SELECT variable, round(psi, 4) AS psi, {state("psi")} AS estado, n_referencia, n_lote,
           (SELECT count(*) FROM psi WHERE psi >= 0.25) AS n_en_alerta,
           (SELECT count(*) FROM psi WHERE psi >= 0.25) > 0 AS alerta FROM psi""", "test", TRIP_PSI))
def _(spark, sf):
    return dr.drift_report(*halves(stored_features(spark, sf)), MODEL.monitored)


@query("drift_profile", with_ctes(f"""
    SELECT variable, round(psi, 4) AS psi, {state("psi")} AS estado, n_referencia, n_lote,
           (SELECT count(*) FROM psi WHERE psi >= 0.25) AS n_en_alerta,
           (SELECT count(*) FROM psi WHERE psi >= 0.25) > 0 AS alerta FROM psi""", "test", TRIP_PSI))
def _(spark, sf):
    """The report from a kept profile: the test split comes as two weeks, whose counts are kept and added up."""
    folder = f"{scratch_dir(spark)}/stages/profile-{uuid.uuid4().hex}"
    train, test = halves(stored_features(spark, sf))
    for name, part in (("w1", F.col("id").endswith("7")), ("w2", ~F.col("id").endswith("7")), ("w1", F.col("id").endswith("7"))):
        frames = monitoring.monitor_batch(test.filter(part), f"{folder}/reference", lambda: train, counts_path=f"{folder}/counts", name=name)
    return frames["acumulado"]


@query("target_drift", with_ctes(PSI_ROW, "test", psi_ctes(
    long_sql("train", ["trip_duration"]), long_sql("test", ["trip_duration"]))))
def _(spark, sf):
    return r6(dr.target_drift(*halves(stored_features(spark, sf)), "trip_duration"), "psi")


@query("split_drift_check", with_ctes(
    f"SELECT variable, round(psi, 4) AS psi, {state('psi')} AS estado FROM psi", "test",
    psi_ctes(long_sql("train", MODEL.split_checked), long_sql("test", MODEL.split_checked))))
def _(spark, sf):
    return dr.split_drift_check(stored_features(spark, sf), MODEL.split_checked)


@query("categorical_psi", with_ctes(" UNION ALL ".join(f"""
    SELECT '{c}' AS variable, round(sum((pa - pr) * ln(pa / pr)), 6) AS psi, CAST(max(nr) AS BIGINT) AS n_referencia,
           CAST(max(nw) AS BIGINT) AS n_lote
    FROM (SELECT greatest(1e-6, r / sum(r) OVER ()) AS pr, greatest(1e-6, w / sum(w) OVER ()) AS pa,
                 sum(r) OVER () AS nr, sum(w) OVER () AS nw
          FROM (SELECT {c}, count(*) FILTER (split_flag = 'train') AS r, count(*) FILTER (split_flag = 'test') AS w
                FROM everything GROUP BY 1))""" for c in ("es_aeropuerto", "store_and_fwd_flag")), "everything"))
def _(spark, sf):
    return r6(dr.categorical_psi(*halves(stored_features(spark, sf)), ["es_aeropuerto", "store_and_fwd_flag"]), "psi")


@query("drift_history", with_ctes(f"""
    SELECT 'lote' AS lote, CASE variable WHEN 'trip_duration' THEN 'objetivo_duracion' ELSE variable END AS variable,
           CASE variable WHEN 'trip_duration' THEN round(psi, 6) ELSE round(psi, 4) END AS psi,
           {state("psi")} AS estado, n_referencia, n_lote FROM psi""", "test",
    psi_ctes(long_sql("train", [*MODEL.monitored, "trip_duration"]), long_sql("test", [*MODEL.monitored, "trip_duration"]))))
def _(spark, sf):
    train, test = halves(stored_features(spark, sf))
    rows = dr.drift_history(dr.drift_report(train, test, MODEL.monitored), dr.target_drift(train, test, "trip_duration"), "lote")
    return r6(writers.append_history(rows, scratch_tables(spark).drift).drop("evaluado_en"), "psi")


NIGHT_SQL = "pickup_hour IN (22, 23, 0, 1, 2, 3, 4, 5)"


def copies_sql(increase):
    """Copies per row for a higher share of night rows."""
    target = f"least(0.95, p * {1 + increase})"
    weight = f"CASE WHEN {NIGHT_SQL} THEN {target} / p ELSE (1 - {target}) / (1 - p) END"
    return (f"SELECT *, CAST(floor(w) AS INTEGER) + ({share_sql('id', 'share')} < w - floor(w))::INT AS copias "
            f"FROM (SELECT test.*, {weight} AS w FROM test, (SELECT avg(({NIGHT_SQL})::INT) AS p FROM test))")


@query("resample_share", with_ctes("""
    SELECT id, pickup_hour, count(*) AS copias FROM (SELECT id, pickup_hour, unnest(range(copias)) FROM x) GROUP BY 1, 2""",
    "test", {"x": copies_sql(0.5)}))
def _(spark, sf):
    return sc.resample_share(halves(features(spark, sf))[1], 0.5).groupBy("id", "pickup_hour").agg(F.count(F.lit(1)).alias("copias"))


TOP3 = "(SELECT pickup_cluster FROM test GROUP BY 1 ORDER BY count(*) DESC, pickup_cluster LIMIT 3)"


def thinned_sql(intensity):
    return f"(pickup_cluster NOT IN {TOP3} OR {share_sql('id', 'thin')} < {1 - min(intensity, 0.95)!r})"


@query("thin_top_categories", with_ctes(f"SELECT id, pickup_cluster FROM test WHERE {thinned_sql(0.5)}", "test"))
def _(spark, sf):
    return sc.thin_top_categories(halves(features(spark, sf))[1], 0.5).select("id", "pickup_cluster")


@query("scale_columns", with_ctes("""
    SELECT id, distancia_haversine_km * 2 AS distancia_haversine_km,
           distancia_manhattan_km * 2 AS distancia_manhattan_km FROM test""", "test"))
def _(spark, sf):
    return sc.scale_columns(halves(features(spark, sf))[1], 1.0).select("id", *sc.SCALED)


SWEEP = INTENSITIES


def sweep_sql() -> str:
    """Every scenario written out as its own batch, then the same PSI per scenario."""
    extra, parts = {}, []
    for n, i in enumerate(SWEEP):
        scaled = ", ".join(f"{c} * {1 + i!r} AS {c}" for c in sc.SCALED)
        extra[f"n{n}"] = f"SELECT x.* FROM ({copies_sql(i)}) x, range(10) k(i) WHERE k.i < copias" if i else "SELECT * FROM test"
        extra[f"z{n}"] = f"SELECT * FROM test WHERE {thinned_sql(i)}" if i else "SELECT * FROM test"
        extra[f"d{n}"] = f"SELECT * REPLACE ({scaled}) FROM test"
        for letter, name in (("n", sc.NIGHT), ("z", sc.ZONES), ("d", sc.DISTANCE)):
            parts.append(f"SELECT '{name}|{i!r}|' || variable AS variable, valor FROM ({long_sql(f'{letter}{n}', MODEL.monitored)})")
    cases = " UNION ALL ".join(f"SELECT '{name}|{i!r}|' AS caso" for i in SWEEP for name in (sc.NIGHT, sc.ZONES, sc.DISTANCE))
    reference = f"SELECT caso || variable AS variable, valor FROM ({long_sql('train', MODEL.monitored)}), ({cases})"
    extra |= psi_ctes(reference, " UNION ALL ".join(parts))
    return with_ctes("""
        SELECT split_part(variable, '|', 1) AS escenario, CAST(split_part(variable, '|', 2) AS DOUBLE) AS intensidad,
               round(max(psi), 4) AS psi_maximo, count(*) FILTER (psi >= 0.25) AS n_alerta, bool_or(psi >= 0.25) AS alerta
        FROM psi GROUP BY 1, 2""", "test", extra)


@query("sensitivity_sweep", sweep_sql())
def _(spark, sf):
    return sc.sensitivity_sweep(*halves(stored_features(spark, sf)), MODEL.monitored, SWEEP)


@query("sweep_pivot", "SELECT intensidad, " + ", ".join(
    f"round(max(psi_maximo) FILTER (escenario = '{s}'), 3) AS \"{s}\"" for s in (sc.NIGHT, sc.ZONES, sc.DISTANCE))
    + f" FROM ({sweep_sql()}) GROUP BY 1")
def _(spark, sf):
    return sc.sweep_pivot(sc.sensitivity_sweep(*halves(stored_features(spark, sf)), MODEL.monitored))


@query("min_detected_intensity", f"""
    SELECT escenario, min(intensidad) FILTER (alerta) AS intensidad_minima FROM ({sweep_sql()}) GROUP BY 1""")
def _(spark, sf):
    return sc.min_detected_intensity(sc.sensitivity_sweep(*halves(stored_features(spark, sf)), MODEL.monitored))


WEEK_ERRORS = """
    SELECT pickup_dayofweek, round(avg(abs(p_distancia_hora - trip_duration)) / 60, 6) AS mae_min,
           (SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 FROM scored WHERE split_flag = 'train') AS ref
    FROM scored WHERE split_flag = 'test' GROUP BY 1"""


@query("degradation_level", with_ctes("""
    SELECT pickup_dayofweek, mae_min, CASE WHEN mae_min > ref * 1.30 THEN 'critico' WHEN mae_min > ref * 1.15 THEN 'atencion'
           ELSE 'normal' END AS nivel FROM w""", "scored", {"w": WEEK_ERRORS}))
def _(spark, sf):
    rows = scored(spark, sf)
    error = F.avg(F.abs(F.col("p_distancia_hora") - F.col("trip_duration"))) / 60
    train, test = halves(rows)
    reference = train.agg(error.alias("ref"))
    by_day = test.groupBy("pickup_dayofweek").agg(F.round(error, 6).alias("mae_min"))
    return by_day.withColumn("nivel", al.degradation_level(F.col("mae_min"), reference.scalar()))


@query("degradation_limits", with_ctes("""
    SELECT round(m, 6) AS mae_referencia, round(m * 1.15, 6) AS limite_atencion, round(m * 1.30, 6) AS limite_critico
    FROM (SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 AS m FROM scored WHERE split_flag = 'test')""", "scored"))
def _(spark, sf):
    errors = test_metrics(spark, sf).filter(F.col("modelo") == model.DISTANCE_HOUR)
    return r6(al.degradation_limits(errors), "mae_referencia", "limite_atencion", "limite_critico")


@query("coverage_loss", """
    WITH r AS (SELECT 'c_nationkey' AS variable, CAST(c_nationkey AS VARCHAR) AS categoria, count(*) AS n FROM customer GROUP BY 2
               UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM customer GROUP BY 2),
         s AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS k, c_mktsegment AS m FROM customer WHERE c_acctbal > 9900)
    SELECT variable, categoria, round(n / total, 6) AS peso FROM
      (SELECT *, sum(n) OVER (PARTITION BY variable) AS total FROM r)
    WHERE n / total > 0.03 AND NOT (variable = 'c_nationkey' AND categoria IN (SELECT k FROM s))
      AND NOT (variable = 'c_mktsegment' AND categoria IN (SELECT m FROM s))""")
def _(spark, sf):
    customers = table(spark, sf, "customer")
    lost = al.coverage_loss(customers, customers.filter("c_acctbal > 9900"), ["c_nationkey", "c_mktsegment"], 0.03)
    return r6(lost, "peso")


ALERTS_SQL = """
    SELECT disparador, severidad, round(valor, 6) AS valor, round(umbral, 6) AS umbral, coalesce(valor > umbral, FALSE) AS activa FROM (
      SELECT 'Calidad degradada' AS disparador, 'Alta' AS severidad,
             (SELECT count(*) FILTER (NOT es_valido) * 100.0 / count(*) FROM flagged) AS valor, 0.21 * 3 AS umbral
      UNION ALL SELECT 'Deriva de covariables', 'Media', (SELECT max(psi) FROM psi WHERE variable <> 'trip_duration'), 0.15
      UNION ALL SELECT 'Deriva del objetivo', 'Alta', (SELECT psi FROM psi WHERE variable = 'trip_duration'), 0.15
      UNION ALL SELECT 'Cobertura perdida', 'Media', (SELECT count(*) FROM (
          SELECT pickup_cluster FROM train GROUP BY 1 HAVING count(*) > 0.05 * (SELECT count(*) FROM train)
          EXCEPT SELECT pickup_cluster FROM test)), 0
      UNION ALL SELECT 'Degradacion del error', 'Alta', (SELECT m FROM mt), (SELECT m FROM mr) * 1.15
      UNION ALL SELECT 'Degradacion severa', 'Critica', (SELECT m FROM mt), (SELECT m FROM mr) * 1.30
      UNION ALL SELECT 'Ausencia de lote', 'Media', (SELECT CASE WHEN count(*) FILTER (pickup_datetime >= TIMESTAMP '2024-02-01') = 0
          THEN 1 ELSE 0 END FROM test), 0
      UNION ALL SELECT 'Fallo de carga', 'Critica', 0, 0)"""


@query("alert_table", with_ctes(ALERTS_SQL, "scored", {
    **psi_ctes(long_sql("train", [*MODEL.monitored, "trip_duration"]), long_sql("test", [*MODEL.monitored, "trip_duration"])),
    "mt": "SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 AS m FROM scored WHERE split_flag = 'test'",
    "mr": "SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 AS m FROM scored WHERE split_flag = 'train'"}))
def _(spark, sf):
    rows = scored(spark, sf)
    train, test = halves(rows)
    errors = rows.agg(
        (F.avg(F.when(F.col("split_flag") == "test", F.abs(F.col("p_distancia_hora") - F.col("trip_duration")))) / 60).alias("mae_min"),
        (F.avg(F.when(F.col("split_flag") == "train", F.abs(F.col("p_distancia_hora") - F.col("trip_duration")))) / 60).alias("mae_referencia"))
    table_ = al.alert_table(
        al.quarantine_alert(q.dq_summary(flagged(spark, sf))),
        al.covariate_alert(dr.psi_by_variable(train, test, MODEL.monitored)),
        al.target_alert(dr.target_drift(train, test, "trip_duration")),
        al.coverage_alert(al.coverage_loss(train, test, ["pickup_cluster"])),
        al.error_alerts(errors),
        al.missing_batch_alert(test, "pickup_datetime", "2024-02-01"),
        al.failed_load_alert(audit.load_check(bronze.bronze_frame(raw_trips(spark, sf), "train.csv"))),
    )
    return r6(table_, "valor", "umbral")


@query("retrain_trigger", """
    WITH w AS (SELECT date_trunc('day', ts) AS d, avg((event_type = 'error')::INT) AS e FROM events GROUP BY 1)
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS evaluado_en, e > (SELECT avg((event_type = 'error')::INT) FROM events) AS alta,
           e > (SELECT avg((event_type = 'error')::INT) FROM events)
             AND coalesce(lag(e) OVER (ORDER BY d) > (SELECT avg((event_type = 'error')::INT) FROM events), FALSE) AS reentrenar
    FROM w""")
def _(spark, sf):
    events = table(spark, sf, "events")
    is_error = (F.col("event_type") == "error").cast("int")
    usual = events.agg(F.avg(is_error).alias("e"))
    history = events.groupBy(F.to_date("ts").alias("evaluado_en")).agg(F.avg(is_error).alias("e")).select(
        F.col("evaluado_en").cast("string").alias("evaluado_en"), F.lit(al.HIGH).alias("severidad"),
        (F.col("e") > usual.scalar()).alias("activa"))
    return al.retrain_trigger(history)


@query("incremental_batch", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, count(*) AS n, round(sum(value), 2) AS total FROM events
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY 1""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    path = f"{scratch_dir(spark)}/stages/days-{uuid.uuid4().hex}"
    for day in ("2024-01-15", "2024-01-22", "2024-01-15"):
        stored = replace_days(incremental_batch(events, day, "ts"), path, covered=batch_days(spark, day))
    return dated(stored.groupBy("fecha").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")))


# --- Whole runs through tables -----------------------------------------------

@query("run_bronze", with_ctes(f"""
    SELECT count(*) AS n_filas, count(DISTINCT id) AS n_ids, count(DISTINCT sha256({HASHED})) AS n_hash FROM raw""", "raw"))
def _(spark, sf):
    names = scratch_tables(spark)
    bronze.run_bronze(spark, csv_copy(spark, sf), tables=names)
    return audit.load_check(spark.table(names.raw_trips)).select("n_filas", "n_ids", "n_hash")


@query("run_bronze_scoring", with_ctes("SELECT count(*) AS n_filas, count(DISTINCT id) AS n_ids, 9 AS n_columnas FROM raw", "raw"))
def _(spark, sf):
    names = scratch_tables(spark)
    bronze.run_bronze(spark, csv_copy(spark, sf, "scoring"), origin="scoring", tables=names)
    rows = spark.table(names.raw_scoring)
    known = [c for c in rows.columns if not c.startswith("_")]
    return audit.load_check(rows).select("n_filas", "n_ids", F.lit(len(known)).alias("n_columnas"))


@query("run_batch", with_ctes("""
    SELECT 'clean' AS capa, CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS fecha, count(*) AS n, CAST(sum(trip_duration) AS BIGINT) AS segundos
    FROM clean WHERE pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-22' GROUP BY 2
    UNION ALL SELECT 'quarantine', CAST(CAST(pickup_datetime AS DATE) AS VARCHAR), count(*), CAST(sum(trip_duration) AS BIGINT)
    FROM quarantine WHERE pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-22' GROUP BY 2
    UNION ALL SELECT 'analytics', CAST(CAST(pickup_datetime AS DATE) AS VARCHAR), count(*), CAST(sum(pickup_cluster) AS BIGINT)
    FROM zoned WHERE pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-22' GROUP BY 2
    UNION ALL SELECT 'features', CAST(CAST(pickup_datetime AS DATE) AS VARCHAR), count(*), CAST(sum(dropoff_cluster) AS BIGINT)
    FROM zoned WHERE pickup_datetime >= '2024-01-08' AND pickup_datetime < '2024-01-22' GROUP BY 2""", "zoned"))
def _(spark, sf):
    """Two weeks one after the other, the first one twice, are the same as both at once."""
    folder = f"{scratch_dir(spark)}/stages/batches-{uuid.uuid4().hex}"
    for date in ("2024-01-15", "2024-01-22", "2024-01-15"):
        stored = batches.run_batch(raw_trips(spark, sf), date, folder, CENTROIDS, LIMITS)
    added = {"clean": "trip_duration", "quarantine": "trip_duration", "analytics": "pickup_cluster", "features": "dropoff_cluster"}
    parts = [stored[layer].groupBy(F.lit(layer).alias("capa"), F.col("fecha").cast("string").alias("fecha")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(column).cast("bigint").alias("segundos")) for layer, column in added.items()]
    return od.union_parts(*parts)


LATE_SPAN = "fecha BETWEEN '2024-01-08' AND '2024-01-21' AND fecha <> '2024-01-12'"


@query("late_batches", with_ctes(f"""
    SELECT * FROM (
      SELECT 'clean' AS capa, strftime(pickup_datetime, '%Y-%m-%d') AS fecha, id, trip_duration AS segundos, passenger_count AS a, vendor_id AS b FROM clean
      UNION ALL SELECT 'quarantine', strftime(pickup_datetime, '%Y-%m-%d'), id, trip_duration, passenger_count, vendor_id FROM quarantine
      UNION ALL SELECT 'analytics', strftime(pickup_datetime, '%Y-%m-%d'), id, trip_duration, pickup_cluster, CAST(pickup_hour AS VARCHAR) FROM zoned
      UNION ALL SELECT 'features', strftime(pickup_datetime, '%Y-%m-%d'), id, trip_duration, dropoff_cluster, split_flag FROM zoned)
    WHERE {LATE_SPAN}""", "zoned"))
def _(spark, sf):
    """Weeks out of order and twice, copies in a week, in a late delivery and across both, a day that loses its rows: every row of every layer."""
    folder = f"{scratch_dir(spark)}/stages/late-{uuid.uuid4().hex}"
    rows = raw_trips(spark, sf)
    number, day = F.substring("id", 3, 20).cast("long"), F.substring("pickup_datetime", 1, 10)
    first, kept = rows.filter(number % 3 != 0), day != "2024-01-12"
    late = rows.filter(kept & day.between("2024-01-08", "2024-01-21") & ((number % 3 == 0) | (number % 5 == 0)))
    batches.run_batch(first, "2024-01-22", folder, CENTROIDS, LIMITS)
    batches.run_batch(first, "2024-01-15", folder, CENTROIDS, LIMITS)
    batches.late_batch(late.unionByName(late), "tardia", folder, CENTROIDS, LIMITS)
    batches.run_batch(first.unionByName(first).filter(kept), "2024-01-15", folder, CENTROIDS, LIMITS)
    stored = batches.late_batch(late, "tardia", folder, CENTROIDS, LIMITS)
    shown = {"clean": ("passenger_count", "vendor_id"), "quarantine": ("passenger_count", "vendor_id"),
             "analytics": ("pickup_cluster", "pickup_hour"), "features": ("dropoff_cluster", "split_flag")}
    return od.union_parts(*[stored[layer].select(
        F.lit(layer).alias("capa"), F.col("fecha").cast("string").alias("fecha"), "id", F.col("trip_duration").alias("segundos"),
        F.col(a).alias("a"), F.col(b).cast("string").alias("b")) for layer, (a, b) in shown.items()])


def demand_sql(span):
    """The demand table of the trips of some days."""
    return CTES["demand"].replace("FROM zoned GROUP BY ALL", f"FROM zoned WHERE {span} GROUP BY ALL")


@query("batch_demand", with_ctes(demand_sql("pickup_datetime >= '2024-01-01' AND pickup_datetime < '2024-01-22'"), "zoned"))
def _(spark, sf):
    """The demand table after three weeks, one of them taken twice, each merged into the counts kept of the others."""
    folder = f"{scratch_dir(spark)}/stages/demand-{uuid.uuid4().hex}"
    for date in ("2024-01-22", "2024-01-08", "2024-01-15", "2024-01-08"):
        stored = batches.run_batch(raw_trips(spark, sf), date, folder, CENTROIDS, LIMITS)
    # The SQL's distances have six places, so the speed follows from a median of six places here too.
    return dm.demand_columns(r6(stored["demand"], "distancia_mediana_km"), demand_state.KEYS)


@query("run_alerts", with_ctes(ALERTS_SQL.replace(
    "SELECT pickup_cluster FROM train GROUP BY 1 HAVING count(*) > 0.05 * (SELECT count(*) FROM train)\n          EXCEPT SELECT pickup_cluster FROM test",
    "(SELECT 'c', pickup_cluster FROM train GROUP BY 2 HAVING count(*) > 0.05 * (SELECT count(*) FROM train) "
    "EXCEPT SELECT 'c', pickup_cluster FROM test) UNION ALL (SELECT 'h', pickup_hour FROM train GROUP BY 2 "
    "HAVING count(*) > 0.05 * (SELECT count(*) FROM train) EXCEPT SELECT 'h', pickup_hour FROM test)"), "scored", {
    **psi_ctes(long_sql("train", [*MODEL.monitored, "trip_duration"]), long_sql("test", [*MODEL.monitored, "trip_duration"])),
    "mt": "SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 AS m FROM scored WHERE split_flag = 'test'",
    "mr": "SELECT avg(abs(p_distancia_hora - trip_duration)) / 60 AS m FROM scored WHERE split_flag = 'train'"}))
def _(spark, sf):
    rows = stage_table(scored(spark, sf), "scored", partition_by="split_flag")
    train, test = halves(rows)
    load = audit.load_check(bronze.bronze_frame(raw_trips(spark, sf), "train.csv"))
    frames = alerting.run_alerts(spark, train, test, q.dq_summary(flagged(spark, sf)), load, "2024-02-01",
                                 "p_distancia_hora", scratch_tables(spark), LIMITS)
    return r6(frames["alertas"].drop("evaluado_en"), "valor", "umbral")


def through_silver(spark, sf):
    names = scratch_tables(spark)
    writers.overwrite_table(bronze.bronze_frame(raw_trips(spark, sf), "train.csv"), names.raw_trips)
    return names, silver.run_silver(spark, names, LIMITS)


@query("run_silver", with_ctes(DQ_SQL.replace("'trips' AS tabla_origen", "(SELECT count(*) FROM clean) AS limpias"), "clean"))
def _(spark, sf):
    names, frames = through_silver(spark, sf)
    n = spark.table(names.clean).agg(F.count(F.lit(1)).alias("n"))
    return r6(frames.metrics, "pct_fallo").withColumn("limpias", n.scalar()).drop("tabla_origen", "evaluado_en")


def through_gold(spark, sf):
    names, _ = through_silver(spark, sf)
    return names, gold.run_gold(spark, names, LIMITS)


def through_fixed_zones(spark, sf):
    """As :func:`through_gold`, with centres that SQL knows."""
    names, _ = through_silver(spark, sf)
    gold.run_gold(spark, names, LIMITS, centroids=CENTROIDS)
    return names


@query("run_gold", with_ctes("""
    SELECT split_flag, count(*) AS n, CAST(sum(trip_duration) AS BIGINT) AS segundos, CAST(sum(es_aeropuerto) AS BIGINT) AS aeropuerto,
           round(sum(distancia_haversine_km), 3) AS km FROM enriched GROUP BY 1""", "enriched"))
def _(spark, sf):
    _, frames = through_gold(spark, sf)
    return frames.features.groupBy("split_flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("trip_duration").alias("segundos"),
        F.sum("es_aeropuerto").alias("aeropuerto"), F.round(F.sum("distancia_haversine_km"), 3).alias("km"))


@query("run_eda", with_ctes("""
    SELECT count(*) AS n_viajes, round(avg(trip_duration), 6) AS media_seg,
           CAST(quantile_disc(trip_duration, 0.5) AS DOUBLE) AS mediana_seg FROM enriched""", "enriched"))
def _(spark, sf):
    return eda.run_eda(spark, through_fixed_zones(spark, sf))["resumen"].select(
        "n_viajes", F.round("target.media_seg", 6).alias("media_seg"), "target.mediana_seg")


@query("run_model", with_ctes("SELECT modelo, n, true AS mejor_que_calendario FROM (SELECT unnest(["
       + ", ".join(f"'{m}'" for m in (model.DISTANCE_HOUR, model.RIDGE, model.GBT, model.TUNED))
       + "]) AS modelo), (SELECT count(*) AS n FROM enriched WHERE split_flag = 'test')", "enriched"))
def _(spark, sf):
    names = through_fixed_zones(spark, sf)
    found = model.run_model(spark, names, FIRST_DAY, LIMITS, md.GRID[:1])["comparacion"]
    calendar = found.filter(F.col("modelo") == model.CALENDAR).select("rmsle").scalar()
    tested = spark.table(names.features).filter("split_flag = 'test'").agg(F.count(F.lit(1))).scalar()
    return found.filter(F.col("modelo") != model.CALENDAR).select(
        "modelo", tested.alias("n"), (F.col("rmsle") < calendar).alias("mejor_que_calendario"))


#: Distances are rounded in the SQL layers only, so their bins may differ by a row.
UNROUNDED = ", ".join(f"'{c}'" for c in ("distancia_haversine_km", "distancia_manhattan_km", "bearing_deg"))


@query("run_monitoring", with_ctes(f"""
    SELECT 'particion de evaluacion' AS lote, CASE variable WHEN 'trip_duration' THEN 'objetivo_duracion' ELSE variable END AS variable,
           CASE variable WHEN 'trip_duration' THEN round(psi, 6) ELSE round(psi, 4) END AS psi,
           {state("psi")} AS estado, n_referencia, n_lote FROM psi WHERE variable NOT IN ({UNROUNDED})""", "test",
    psi_ctes(long_sql("train", [*MODEL.monitored, "trip_duration"]), long_sql("test", [*MODEL.monitored, "trip_duration"]))))
def _(spark, sf):
    frames = monitoring.run_monitoring(spark, through_fixed_zones(spark, sf))
    return r6(frames["historial"].filter(f"variable NOT IN ({UNROUNDED})").drop("evaluado_en"), "psi")


# --- Training-data operators: only where their folder is there -----------------

if find_spec("tripstrata.llm"):
    from tripstrata.llm import queries as llm_queries

    _QUERIES.update(llm_queries.QUERIES)
    _ORACLE.update(llm_queries.ORACLE)

if find_spec("corpus_pipeline") and find_spec("tripstrata.llm"):
    import corpus_pipeline

    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

# --- Contract ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Raw trips to typed, checked, enriched demand by hour."""
    return dm.hour_profile(dm.demand_aggregate(zoned(spark, "/root/testdata/sf0.001")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
