"""Null checks, rules, quality metrics, quarantine and schema guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.config import DROPOFF, MODEL, PICKUP, RULE_NAMES, THRESHOLDS, VALID_COLUMN, Thresholds
from tripstrata.functions.geo import haversine_km, speed_kmh
from tripstrata.operators.quantiles import quantiles
from tripstrata.sources.staging import stage_table


def _as_rows(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], list(columns), name, value)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _as_rows(counts, columns, "columna", "nulos")


def cast_losses(raw: DataFrame, columns: Sequence[str], typed) -> DataFrame:
    """Values lost in typing per column: text present before, NULL after.

    ``typed`` is the typing function. Raw and typed values are compared row by row in
    one pass, so a loss cannot hide behind a NULL gained elsewhere.
    """
    kept = raw.withColumns({f"_raw_{c}": F.col(c) for c in columns})
    both = typed(kept)
    counts = both.agg(*[
        F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in columns
    ])
    return _as_rows(counts, columns, "columna", "valores_perdidos")


def assert_no_cast_losses(losses: DataFrame) -> None:
    lost = {r["columna"]: r["valores_perdidos"] for r in losses.filter("valores_perdidos > 0").collect()}
    if lost:
        raise ValueError(f"typing lost values: {lost}")


def dedup_exact(df: DataFrame, hash_col: str = "_row_hash") -> DataFrame:
    """One row per hash, without shuffling the rows that have no copy.

    A first pass exchanges only an 8-byte fingerprint per row and keeps the few that
    occur more than once; only rows carrying one are grouped by the full hash, where
    copies of one row collapse inside each task before the exchange. All other rows
    pass straight through. Two different hashes sharing a fingerprint merely take the
    longer way.
    """
    fingerprint = F.xxhash64(hash_col)
    repeated = stage_table(
        df.groupBy(fingerprint.alias("_fp")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_fp"),
        "repeated",
    )
    tagged = df.withColumn("_fp", fingerprint)
    single = tagged.join(repeated, "_fp", "left_anti")
    copies = tagged.join(repeated, "_fp", "left_semi").dropDuplicates([hash_col])
    return single.unionByName(copies).select(*df.columns)


def rule_range(column: str, low, high) -> Column:
    """Inclusive range."""
    return F.col(column).between(low, high)


def rule_bbox(point: tuple[str, str], t: Thresholds = THRESHOLDS) -> Column:
    """Point inside the inclusive latitude/longitude box."""
    lat, lon = point
    return F.col(lat).between(t.lat_min, t.lat_max) & F.col(lon).between(t.lon_min, t.lon_max)


def rule_not_null(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def trip_rules(t: Thresholds = THRESHOLDS) -> dict[str, Column]:
    """The five rules of a valid trip, by flag name."""
    conditions = (
        rule_range("trip_duration", t.duration_min_s, t.duration_max_s),
        rule_range("passenger_count", t.passengers_min, t.passengers_max),
        rule_bbox(PICKUP, t),
        rule_bbox(DROPOFF, t),
        rule_not_null(["id", "pickup_datetime", "trip_duration"]),
    )
    return dict(zip(RULE_NAMES, conditions))


def flag_rules(df: DataFrame, rules: dict[str, Column] | None = None, valid: str = VALID_COLUMN) -> DataFrame:
    """One boolean per rule and their conjunction.

    A rule that cannot be decided (NULL input) counts as failed, so every row is either
    valid or quarantined and none is lost between the two.
    """
    rules = rules or trip_rules()
    flagged = df.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()})
    return flagged.withColumn(valid, reduce(and_, [F.col(name) for name in rules]))


def dq_summary(flagged: DataFrame, rules: Sequence[str] = RULE_NAMES, valid: str = VALID_COLUMN) -> DataFrame:
    """Failures per rule, invalid rows and all rows, in one pass over the flags."""
    return flagged.agg(
        *[F.count_if(~F.col(r)).alias(r) for r in rules],
        F.count_if(~F.col(valid)).alias("total_invalidas"),
        F.count(F.lit(1)).alias("total_filas"),
    )


def dq_metrics(flagged: DataFrame, source: str, rules: Sequence[str] = RULE_NAMES) -> DataFrame:
    """Rule, failed rows, evaluated rows and failure percentage: one row per rule."""
    return (
        dq_summary(flagged, rules)
        .unpivot(["total_filas"], list(rules), "regla", "filas_fallidas")
        .select(
            "regla",
            "filas_fallidas",
            F.col("total_filas").alias("filas_evaluadas"),
            (F.col("filas_fallidas") / F.nullif("total_filas", F.lit(0)) * 100).alias("pct_fallo"),
            F.lit(source).alias("tabla_origen"),
            F.current_timestamp().alias("evaluado_en"),
        )
    )


def quarantine_split(flagged: DataFrame, rules: Sequence[str] = RULE_NAMES,
                     valid: str = VALID_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the flags, invalid rows with them)."""
    return flagged.filter(valid).drop(*rules, valid), flagged.filter(~F.col(valid))


def rule_combinations(quarantine: DataFrame, rules: Sequence[str] = RULE_NAMES) -> DataFrame:
    """How often each pattern of rules fails, most frequent first."""
    return (
        quarantine.groupBy(*rules).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *rules)
    )


def quarantine_sample(quarantine: DataFrame, n: int = 20, key: str = "id") -> DataFrame:
    """First ``n`` rejected rows by key, for inspection."""
    columns = [key, "pickup_datetime", "trip_duration", "passenger_count", *PICKUP, *RULE_NAMES]
    return quarantine.select(*columns).orderBy(key).limit(n)


def threshold_audit(quarantine: DataFrame) -> DataFrame:
    """Are over-long trips real? Implied speeds and hours of rows failing only on duration.

    Takes rejected rows whose duration rule failed with both ends inside the box.
    """
    hours = F.col("trip_duration") / 3600.0
    # Read three times below; a small part of the rejected rows.
    suspects = stage_table(
        quarantine.filter("NOT v_duracion AND v_coords_pickup AND v_coords_dropoff AND trip_duration IS NOT NULL")
        .select(
            hours.alias("horas"),
            haversine_km(*[F.col(c) for c in (*PICKUP, *DROPOFF)]).alias("km"),
            F.col("trip_duration"),
        )
        .withColumn("kmh", speed_kmh(F.col("km"), F.col("trip_duration"))),
        "suspects",
    )
    totals = suspects.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("kmh").alias("velocidad_maxima_kmh"),
        F.avg((F.col("kmh") < 1).cast("double")).alias("prop_menor_1_kmh"),
        F.avg((F.col("kmh") < 5).cast("double")).alias("prop_menor_5_kmh"),
        F.avg((F.col("horas") > 23).cast("double")).alias("prop_mas_23_h"),
        F.max("horas").alias("horas_maximas"),
    )
    long = suspects.unpivot([], ["horas", "km"], "medida", "valor")
    medians = quantiles(long, ["medida"], "valor", [0.5], ["mediana"])
    middle = medians.agg(
        F.max(F.when(F.col("medida") == "horas", F.col("mediana"))).alias("horas_mediana"),
        F.max(F.when(F.col("medida") == "km", F.col("mediana"))).alias("km_mediana"),
    ).select(F.struct("*").alias("m"))
    return totals.withColumn("m", middle.scalar()).select(
        *totals.columns, F.col("m.horas_mediana"), F.col("m.km_mediana")
    )


def select_whitelist(df: DataFrame, key: str = "id", columns: Sequence[str] = MODEL.whitelist,
                     target: str = MODEL.target, target_log: str = MODEL.target_log,
                     split: str = "split_flag") -> DataFrame:
    """Key, declared features, both forms of the target and the split; nothing else."""
    return df.withColumn(target_log, F.log1p(target)).select(key, *columns, target, target_log, split)


def assert_no_leakage(columns: Sequence[str], forbidden: Sequence[str] = MODEL.forbidden,
                      allowed: Sequence[str] = (MODEL.target, MODEL.target_log)) -> None:
    """Fail if a column derived from the target is among the features."""
    leaks = (set(columns) & set(forbidden)) - set(allowed)
    if leaks:
        raise ValueError(f"columns that leak the target: {sorted(leaks)}")


def conservation_check(before: DataFrame, after: dict[str, DataFrame], features: DataFrame,
                       columns: Sequence[str] = MODEL.whitelist) -> DataFrame:
    """Row counts of each output against the input, and NULLs among the features."""
    counts = before.agg(F.lit("entrada").alias("tabla"), F.count(F.lit(1)).alias("filas"))
    for name, df in after.items():
        counts = counts.unionByName(df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas")))
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    nulls = features.agg(F.count_if(any_null).alias("n"))
    return counts.withColumn("filas_con_nulos", nulls.scalar())


def assert_conserved(check: DataFrame, parts: Sequence[str] = ()) -> None:
    """Fail when rows were lost. ``parts`` are tables that together make up the input."""
    rows = check.collect()
    filas = {r["tabla"]: r["filas"] for r in rows}
    expected = filas.pop("entrada")
    found = {"+".join(parts): sum(filas.pop(p) for p in parts)} if parts else {}
    wrong = {name: n for name, n in {**filas, **found}.items() if n != expected}
    if wrong:
        raise ValueError(f"{expected} rows went in, came out: {wrong}")
    if rows[0]["filas_con_nulos"]:
        raise ValueError(f"{rows[0]['filas_con_nulos']} rows have a NULL feature")
