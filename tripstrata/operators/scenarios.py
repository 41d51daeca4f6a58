"""Induced drift: change a batch on purpose and see from what size on it is noticed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.config import INTENSITIES, NIGHT_HOURS, THRESHOLDS, Thresholds
from tripstrata.operators.drift import classify_psi, long_values, psi_terms, reference_cuts, with_bin
from tripstrata.operators.ordering import hash_share

# Names of the three scenarios.
NIGHT, ZONES, DISTANCE = "Sesgo nocturno", "Perdida de zonas principales", "Trayectos mas largos"
SCALED = ("distancia_haversine_km", "distancia_manhattan_km")


def is_night(hour: str = "pickup_hour") -> Column:
    return F.col(hour).isin(*NIGHT_HOURS)


def _copies(weight: Column, key: str, salt: str) -> Column:
    """Whole copies of a row whose expected number is ``weight``; the part of a copy is decided by the key."""
    whole = F.floor(weight)
    return (whole + (hash_share(F.col(key), salt) < weight - whole).cast("int")).cast("int")


def share_copies(flag: Column, share: Column, increase: float, key: str) -> Column:
    """Copies per row that raise the share of flagged rows by ``increase``, at most to ``Thresholds.scenario_ceiling``.

    The key decides alike at every intensity, so a stronger change only adds to a weaker one.
    """
    target = F.least(F.lit(THRESHOLDS.scenario_ceiling), share * (1 + increase))
    weight = F.when(flag, F.try_divide(target, share)).otherwise(F.try_divide(1 - target, 1 - share))
    return _copies(F.coalesce(weight, F.lit(0.0)), key, "share")


def flag_share(df: DataFrame, flag: Column) -> Column:
    """Share of flagged rows, as a subquery."""
    return df.agg(F.avg(flag.cast("double")).alias("p")).scalar()


def resample_share(df: DataFrame, increase: float, flag: Column | None = None, key: str = "id") -> DataFrame:
    """Batch with a higher share of flagged (night) rows and about its old size: rows are dropped or repeated.

    Which rows follows from their keys, so every run and retry gives the same batch.
    """
    flag = is_night() if flag is None else flag
    copies = share_copies(flag, flag_share(df, flag), increase, key)
    return df.withColumn("_copies", copies).filter("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def top_categories(df: DataFrame, column: str, top: int = 3) -> Column:
    """The most frequent categories as an array subquery; ties in category order, NULL is none."""
    largest = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(top)
    return largest.agg(F.collect_list(column)).scalar()


def keep_after_thinning(in_top: Column, intensity: float, key: str) -> Column:
    kept = hash_share(F.col(key), "thin") < 1 - min(intensity, THRESHOLDS.scenario_ceiling)
    return ~F.coalesce(in_top, F.lit(False)) | kept


def thin_top_categories(df: DataFrame, intensity: float, column: str = "pickup_cluster", top: int = 3,
                        key: str = "id") -> DataFrame:
    """Batch that lost a part of the rows in its largest zones."""
    in_top = F.array_contains(top_categories(df, column, top), F.col(column))
    return df.filter(keep_after_thinning(in_top, intensity, key))


def scale_columns(df: DataFrame, intensity: float, columns: Sequence[str] = SCALED) -> DataFrame:
    """Batch whose trips are longer by a factor."""
    return df.withColumns({c: F.col(c) * (1 + intensity) for c in columns})


def sweep_psi(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
              intensities: Sequence[float] = INTENSITIES, key: str = "id", zone: str = "pickup_cluster",
              hour: str = "pickup_hour", bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """PSI of every variable in every scenario and intensity.

    No scenario is materialised. Night and zone scenarios only change how often a row
    counts, so they become weighted counts of the same bins; only the scaled columns are
    binned again. The batch is read once for all scenarios instead of once for each.
    """
    changes = [i for i in intensities if i > 0]
    scaled = [c for c in SCALED if c in columns]
    cuts = reference_cuts(reference, columns, bins)

    night = is_night(hour)
    weights = {f"night_{n}": share_copies(night, F.col("_night"), i, key) for n, i in enumerate(changes)}
    weights |= {
        f"zones_{n}": keep_after_thinning(F.array_contains(F.col("_top"), F.col(zone)), i, key).cast("int")
        for n, i in enumerate(changes)
    }
    weighted = (
        batch.withColumns({"_night": flag_share(batch, is_night(hour)), "_top": top_categories(batch, zone)})
        .withColumns(weights)
        .withColumns({f"{c}@{n}": F.col(c) * (1 + i) for n, i in enumerate(changes) for c in scaled})
    )
    names = list(weights)
    rows = long_values(weighted, [*columns, *[f"{c}@{n}" for n in range(len(changes)) for c in scaled]], names)
    rows = rows.withColumns({"_new": F.lit(1), "_ref": F.lit(0)}).unionByName(
        long_values(reference, columns).withColumns({"_new": F.lit(0), "_ref": F.lit(1), **{w: F.lit(0) for w in names}}))
    rows = rows.withColumns({
        "serie": F.coalesce(F.try_element_at(F.split("variable", "@"), F.lit(2)).cast("int"), F.lit(-1)),
        "variable": F.split_part("variable", F.lit("@"), F.lit(1)),
    })
    counts = with_bin(rows, cuts, bins).groupBy("serie", "variable", "bin").agg(*[F.sum(c).alias(c) for c in ("_new", "_ref", *names)])

    def entry(scenario, intensity, new):
        return F.struct(F.lit(scenario).alias("escenario"), F.lit(float(intensity)).alias("intensidad"),
                        new.cast("bigint").alias("new"), F.col("_ref").cast("bigint").alias("ref"))

    kept = F.when(F.col("variable").isin(*scaled), F.lit(0)).otherwise(F.col("_new")) if scaled else F.col("_new")
    base = [entry(s, 0.0, F.col("_new")) for s in (NIGHT, ZONES, DISTANCE)] if 0.0 in intensities else []
    moved = F.lit(None)
    for n, i in enumerate(changes):
        base += [entry(NIGHT, i, F.col(f"night_{n}")), entry(ZONES, i, F.col(f"zones_{n}")), entry(DISTANCE, i, kept)]
        moved = F.when(F.col("serie") == n, F.array(entry(DISTANCE, i, F.col("_new")))).otherwise(moved)
    cases = F.when(F.col("serie") == -1, F.array(*base)).otherwise(moved)
    per_case = (
        counts.select("variable", "bin", F.explode(cases).alias("c")).select("variable", "bin", "c.*")
        .groupBy("escenario", "intensidad", "variable", "bin").agg(F.sum("new").alias("new"), F.sum("ref").alias("ref"))
    )
    return psi_terms(per_case, ["escenario", "intensidad", "variable"], "ref", "new")


def sensitivity_sweep(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
                      intensities: Sequence[float] = INTENSITIES, t: Thresholds = THRESHOLDS, **options) -> DataFrame:
    """Largest PSI, alarming variables and alert for every scenario and intensity."""
    return summarize_sweep(sweep_psi(reference, batch, columns, intensities, **options), t)


def summarize_sweep(psi: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    alarm = classify_psi(F.col("psi"), t) == "alerta"
    return psi.groupBy("escenario", "intensidad").agg(
        F.round(F.max("psi"), 4).alias("psi_maximo"),
        F.count_if(alarm).alias("n_alerta"),
        F.max(alarm).alias("alerta"),
    )


def sweep_pivot(sweep: DataFrame) -> DataFrame:
    """Largest PSI with one row per intensity and one column per scenario."""
    return sweep.groupBy("intensidad").pivot("escenario", [NIGHT, ZONES, DISTANCE]).agg(
        F.round(F.max("psi_maximo"), 3)).orderBy("intensidad")


def min_detected_intensity(sweep: DataFrame) -> DataFrame:
    """Smallest alarming intensity per scenario, NULL where none in the range was noticed."""
    return sweep.groupBy("escenario").agg(F.min(F.when(F.col("alerta"), F.col("intensidad"))).alias("intensidad_minima"))
