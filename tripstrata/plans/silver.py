"""Clean layer: typing, duplicates, rules, quality metrics and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripstrata.config import TABLES, THRESHOLDS, TableNames, Thresholds
from tripstrata.functions.typing import apply_types
from tripstrata.operators.quality import (
    assert_conserved, assert_no_cast_losses, cast_losses, conservation_check, dedup_exact, dq_metrics, dq_summary,
    flag_rules, quarantine_split, rule_combinations, trip_rules,
)
from tripstrata.sources.staging import drop_stage, stage_table
from tripstrata.sources.writers import append_history, overwrite_table


@dataclass
class SilverFrames:
    flagged: DataFrame | None
    clean: DataFrame
    quarantine: DataFrame
    metrics: DataFrame
    summary: DataFrame
    combinations: DataFrame


def flagged_trips(bronze: DataFrame, t: Thresholds = THRESHOLDS, dedup: bool = True) -> DataFrame:
    """Typed rows without copies, one boolean per rule."""
    rows = dedup_exact(bronze) if dedup and "_row_hash" in bronze.columns else bronze
    return flag_rules(apply_types(rows), trip_rules(t))


def silver_frames(flagged: DataFrame, source: str) -> SilverFrames:
    """Everything derived from the flagged rows. Pass a staged frame: it is read by each result."""
    clean, quarantine = quarantine_split(flagged)
    return SilverFrames(
        flagged, clean, quarantine, dq_metrics(flagged, source), dq_summary(flagged), rule_combinations(quarantine))


def run_silver(spark: SparkSession, tables: TableNames = TABLES, t: Thresholds = THRESHOLDS) -> SilverFrames:
    """Raw table to clean and quarantined tables, with the quality metrics appended to their history.

    The flagged rows are staged once; metrics, both tables and the pattern counts read
    that stage instead of typing and testing the raw rows again. The stage is dropped at the end, so
    ``flagged`` is None in the result: the two tables hold its rows.
    """
    bronze = spark.table(tables.raw_trips)
    business = [c for c in bronze.columns if not c.startswith("_")]
    assert_no_cast_losses(cast_losses(bronze, business, apply_types))
    staged = stage_table(flagged_trips(bronze, t), "flagged", partition_by="es_valido")
    frames = silver_frames(staged, tables.raw_trips)
    append_history(frames.metrics, tables.dq_metrics)
    clean = overwrite_table(frames.clean, tables.clean)
    quarantine = overwrite_table(frames.quarantine, tables.quarantine)
    assert_conserved(
        conservation_check(staged, {"clean": clean, "quarantine": quarantine}, clean, ["id"]), ["clean", "quarantine"])
    summary = dq_summary(staged)
    result = SilverFrames(
        None, clean, quarantine, spark.table(tables.dq_metrics),
        spark.createDataFrame(summary.collect(), summary.schema), rule_combinations(quarantine))
    drop_stage(staged)
    return result
