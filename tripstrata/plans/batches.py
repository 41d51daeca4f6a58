"""Batches through the layers: whole weeks that replace their days, and late deliveries that add to them.

Every layer is stored by day (``fecha``) and delivery (``lote``). A week's run replaces all that is stored for its days,
days that have lost their rows included. A late delivery adds the rows that no other delivery has brought: Bloom filters
of the stored row hashes tell which days can hold copies, and only those are compared exactly. Each run replaces its
own partitions, so it can be repeated after a failure at any point; weeks and deliveries in any order give the tables
of one full run over all rows, as long as a week's run still sees the rows that late deliveries brought before it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import MODEL, THRESHOLDS, VALID_COLUMN, Thresholds
from tripstrata.functions.typing import apply_types
from tripstrata.operators.quality import (
    assert_no_leakage, dedup_exact, dq_metrics, flag_rules, quarantine_split, select_whitelist, trip_rules,
)
from tripstrata.operators.zones import zone_assign
from tripstrata.plans.gold import analytics_frame, enrich
from tripstrata.sources.audit import row_hash
from tripstrata.sources.staging import drop_stage, stage_table
from tripstrata.streaming.copies import build_filters, may_hold
from tripstrata.streaming.demand_state import update_demand
from tripstrata.streaming.incremental import batch_days, clear_partitions, incremental_batch, partitions, write_partitions

#: In the order in which a run writes them: what tells stored rows comes last, then their filters.
LAYERS = ("features", "analytics", "quarantine", "clean")
KEYS = ["fecha", "lote"]
WEEKLY = "semana"


def hashed(raw: DataFrame) -> DataFrame:
    """The raw rows with ``_row_hash`` over their business columns, unless they have it."""
    if "_row_hash" in raw.columns:
        return raw
    return raw.withColumn("_row_hash", row_hash([c for c in raw.columns if not c.startswith("_")]))


def layer_frames(flagged: DataFrame, centroids: Sequence[tuple[float, float]], t: Thresholds) -> dict[str, DataFrame]:
    """The four layers of flagged rows that hold :data:`KEYS`."""
    clean, quarantine = quarantine_split(flagged)
    zoned = zone_assign(enrich(clean, t), centroids)
    whitelist = select_whitelist(zoned).columns
    assert_no_leakage(whitelist)
    features = zoned.withColumn(MODEL.target_log, F.log1p(MODEL.target)).select(*whitelist, *KEYS)
    analytics = analytics_frame(zoned.drop("_row_hash"))
    return {"features": features, "analytics": analytics, "quarantine": quarantine, "clean": clean}


def write_layers(rows: DataFrame, folder: str, centroids: Sequence[tuple[float, float]], t: Thresholds, emptied) -> dict[str, DataFrame]:
    """Write typed rows into all layers and their filters; then clear the partitions that ``emptied`` names, unless just written.

    What does not read each other runs side by side: the products; then what tells stored rows, with its filters after it, beside the demand.
    """
    spark = rows.sparkSession
    flagged = stage_table(flag_rules(rows, trip_rules(t)), "batch", partition_by=VALID_COLUMN)
    frames = layer_frames(flagged, centroids, t) | {"filters": build_filters(flagged, KEYS)}
    metrics = dq_metrics(flagged, folder.rsplit("/", 1)[-1]).drop("evaluado_en")
    kept = {}

    def replace(name: str, own: set[tuple[str, str]]) -> None:
        write_partitions(frames[name], f"{folder}/{name}", KEYS)
        clear_partitions(spark, f"{folder}/{name}", lambda p: emptied(p) and (p["fecha"], p["lote"]) not in own, 2)
        kept[name] = spark.read.schema(frames[name].schema).parquet(f"{folder}/{name}")

    with ThreadPoolExecutor(4) as pool:
        def start(job: Callable, *given) -> Future:
            return pool.submit(inheritable_thread_target(job), *given)

        counted = start(metrics.collect)  # one row per rule
        # At most two rows per day and delivery.
        found = [((str(r.fecha), r.lote), r[VALID_COLUMN]) for r in flagged.select(*KEYS, VALID_COLUMN).distinct().collect()]
        valid, invalid = ({part for part, ok in found if bool(ok) == wanted} for wanted in (True, False))
        held = dict.fromkeys(LAYERS, valid) | {"quarantine": invalid, "filters": valid | invalid}
        features, analytics = (start(replace, name, held[name]) for name in LAYERS[:2])
        analytics.result()
        demand = start(update_demand, kept["analytics"], folder, emptied, KEYS)
        features.result()
        for layer in [start(replace, name, held[name]) for name in LAYERS[2:]]:
            layer.result()
        replace("filters", held["filters"])
        kept["demand"] = demand.result()
        kept["quality"] = spark.createDataFrame(counted.result(), metrics.schema)
    drop_stage(flagged)
    return kept


def run_batch(raw: DataFrame, process_date: str, folder: str, centroids: Sequence[tuple[float, float]],
              t: Thresholds = THRESHOLDS, days: int = 7) -> dict[str, DataFrame]:
    """The ``days`` before ``process_date`` of the raw rows, without copies, typed, checked, enriched and zoned into ``folder``.

    ``raw`` holds all rows of those days: what is stored for them, of any delivery, is replaced, and a day without rows
    ends without files. ``centroids`` are those of the first full run, so a zone keeps its meaning. Rows whose pickup does
    not parse belong to no day; a full load counts and rejects them. Returns the stored layers, the demand table of all
    days, brought up to date from kept counts, as ``demand``, and the metrics of the batch as ``quality``.
    """
    # Read three times when copies are removed: staged, so raw rows are read and typed once.
    typed = stage_table(incremental_batch(apply_types(hashed(raw)), process_date, days=days), "week")
    rows = dedup_exact(typed).withColumn("lote", F.lit(WEEKLY))
    covered = set(batch_days(raw.sparkSession, process_date, days))
    kept = write_layers(rows, folder, centroids, t, lambda p: p["fecha"] in covered)
    drop_stage(typed)
    return kept


def stored_hashes(spark: SparkSession, folder: str, parts: list[tuple[str, str]]) -> DataFrame:
    """The row hashes stored in some (day, delivery) partitions of the clean and the quarantined rows."""
    wanted = F.lit(False)
    for day in sorted({d for d, _ in parts}):
        own = [lote for d, lote in parts if d == day]
        wanted = wanted | ((F.col("fecha") == F.lit(day).cast("date")) & F.col("lote").isin(own))
    schema = "_row_hash string, fecha date, lote string"
    rows = [spark.read.schema(schema).parquet(f"{folder}/{name}").filter(wanted) for name in ("clean", "quarantine")]
    return rows[0].unionByName(rows[1]).select("_row_hash")


def new_rows(rows: DataFrame, folder: str, delivery: str) -> DataFrame:
    """Rows (with ``fecha``, each hash once) that no other delivery stored in ``folder`` has."""
    spark = rows.sparkSession
    known = {(p["fecha"], p["lote"]) for p in partitions(spark, f"{folder}/filters", 2) if p["lote"] != delivery}
    if not known:
        return rows
    filters = spark.read.schema("bitmaps long, bucket long, bitmap binary, fecha date, lote string").parquet(
        f"{folder}/filters").filter(F.col("lote") != delivery)
    doubtful = stage_table(may_hold(rows, filters, "fecha", KEYS), "doubtful")
    parts = [(str(r.fecha), r.lote) for r in doubtful.select(*KEYS).distinct().collect()]  # days and deliveries, not rows
    if not parts:
        return rows
    copies = stored_hashes(spark, folder, parts).join(doubtful.select("_row_hash"), "_row_hash", "left_semi")
    return rows.join(stage_table(copies, "copies"), "_row_hash", "left_anti")


def late_batch(raw: DataFrame, delivery: str, folder: str, centroids: Sequence[tuple[float, float]],
               t: Thresholds = THRESHOLDS) -> dict[str, DataFrame]:
    """Add the rows of a late delivery, of whatever days, that no other delivery has brought.

    ``delivery`` is its name (a letter, then letters, digits, ``-`` and ``_``; not the weekly one). Running it again replaces what it
    stored before, so rows it no longer holds go. Copies within the delivery count once.
    """
    if not re.fullmatch(r"[A-Za-z][\w\-]*", delivery) or delivery == WEEKLY:
        raise ValueError(f"not a name of a delivery: {delivery}")
    dated = apply_types(hashed(raw)).withColumn("fecha", F.to_date("pickup_datetime")).filter("fecha IS NOT NULL")
    typed = stage_table(dated, "late")  # as in a week's run
    own = stage_table(dedup_exact(typed), "delivery")
    drop_stage(typed)
    rows = new_rows(own, folder, delivery).select(*own.columns).withColumn("lote", F.lit(delivery))
    return write_layers(rows, folder, centroids, t, lambda p: p["lote"] == delivery)


def stored_zones(spark: SparkSession, name: str) -> list[tuple[float, float]]:
    """The centres that a full run wrote to its zone table: one row per zone."""
    return [(r.latitud, r.longitud) for r in spark.table(name).orderBy("zona").collect()]
