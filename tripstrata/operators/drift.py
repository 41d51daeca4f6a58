"""Population stability: reference bins, shares, PSI and drift reports.

A reference is cut at its own quantiles; both samples are counted per bin; PSI adds up
the change of shares. All variables of a report go through the same few jobs, with one
row per variable and bin leaving each task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import THRESHOLDS, Thresholds
from tripstrata.operators.quantiles import quantile_cuts


def classify_psi(psi: Column, t: Thresholds = THRESHOLDS) -> Column:
    """estable, vigilar or alerta."""
    return F.when(psi < t.psi_stable, "estable").when(psi < t.psi_alert, "vigilar").otherwise("alerta")


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per row and variable with the value as a double; NULL values are left out."""
    casts = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*keep, *casts).unpivot(list(keep), list(columns), "variable", "valor").filter("valor IS NOT NULL")


def reference_cuts(reference: DataFrame, columns: Sequence[str], bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """Bin edges of every variable of the reference."""
    return quantile_cuts(long_values(reference, columns), ["variable"], "valor", bins)


def with_bin(long: DataFrame, cuts: DataFrame, bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """Add the ``bin`` of every value among the sorted distinct edges of its variable.

    A bin holds its lower edge, the last one also its upper edge. Values below the lowest
    edge go to the first bin; above the highest edge there is none (NULL). With a single
    edge there are no bins at all. Variables without edges drop out.

    The edges travel as plain columns, absent ones as infinity, so that a bin is a sum of
    comparisons in compiled code.
    """
    inner = [f"_e{i}" for i in range(1, bins)]
    last = F.size("cortes") - 1
    edges = cuts.select(
        "variable",
        F.when(last > 0, F.get("cortes", last)).otherwise(F.lit(-math.inf)).alias("_top"),
        *[F.when(F.lit(i) < last, F.get("cortes", F.lit(i))).otherwise(F.lit(math.inf)).alias(name)
          for i, name in enumerate(inner, start=1)],
    )
    passed = sum([(F.col("valor") >= F.col(e)).cast("int") for e in inner], F.lit(0))
    # One row per named variable.
    return (
        long.join(F.broadcast(edges), "variable")
        .withColumn("bin", F.when(F.col("valor") <= F.col("_top"), passed))
        .drop("_top", *inner)
    )


def histogram_share(df: DataFrame, columns: Sequence[str], cuts: DataFrame, bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """Share of values per bin of each variable.

    Values above the highest edge are in no bin but still in the denominator, so the
    shares of a batch need not add up to 1. Empty bins are not listed.
    """
    counts = with_bin(long_values(df, columns), cuts, bins).groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    # The window holds one row per bin.
    total = F.sum("n").over(W.partitionBy("variable"))
    return counts.withColumn("proporcion", F.col("n") / total).filter("bin IS NOT NULL")


def psi_terms(counts: DataFrame, keys: Sequence[str], reference: str, batch: str,
              floor: float = THRESHOLDS.psi_floor) -> DataFrame:
    """PSI per key from counts per bin (``bin`` NULL for values outside): one row per key."""
    # The window holds one row per bin (or category) of a key.
    whole = W.partitionBy(*keys)
    shares = counts.withColumns({
        "n_referencia": F.sum(reference).over(whole), "n_lote": F.sum(batch).over(whole),
    })
    share_ref = F.greatest(F.try_divide(F.col(reference), F.col("n_referencia")), F.lit(floor))
    share_new = F.greatest(F.coalesce(F.try_divide(F.col(batch), F.col("n_lote")), F.lit(0.0)), F.lit(floor))
    term = F.when(F.col("bin").isNotNull(), (share_new - share_ref) * F.log(share_new / share_ref)).otherwise(0.0)
    return shares.groupBy(*keys).agg(
        F.sum(term).alias("psi"), F.max("n_referencia").alias("n_referencia"), F.max("n_lote").alias("n_lote"))


def psi_by_variable(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
                    bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """Unrounded PSI of every variable present in both samples, with the sample sizes.

    Reference and batch are counted in one pass: a union tagged by origin, so no bin has
    to be matched by an outer join. A variable without any reference value has no row.
    """
    present = [c for c in columns if c in batch.columns]
    cuts = reference_cuts(reference, present, bins)
    both = long_values(reference, present).withColumn("_ref", F.lit(1)).unionByName(
        long_values(batch, present).withColumn("_ref", F.lit(0)))
    counts = with_bin(both, cuts, bins).groupBy("variable", "bin").agg(
        F.sum("_ref").alias("ref"), F.sum(1 - F.col("_ref")).alias("new"))
    return psi_terms(counts, ["variable"], "ref", "new")


def categorical_psi(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
                    floor: float = THRESHOLDS.psi_floor) -> DataFrame:
    """PSI over the shares of each category instead of quantile bins.

    A flag that is rarely set has a single quantile bin and can never alarm by
    :func:`psi_by_variable`; here every category is a bin.
    """
    present = [c for c in columns if c in batch.columns]

    def counted(df, is_reference):
        cast = df.select(*[F.col(c).cast("string").alias(c) for c in present])
        return cast.unpivot([], present, "variable", "bin").filter("bin IS NOT NULL").withColumn(
            "_ref", F.lit(is_reference))

    counts = counted(reference, 1).unionByName(counted(batch, 0)).groupBy("variable", "bin").agg(
        F.sum("_ref").alias("ref"), F.sum(1 - F.col("_ref")).alias("new"))
    return psi_terms(counts, ["variable"], "ref", "new", floor)


def drift_report(reference: DataFrame, batch: DataFrame, columns: Sequence[str],
                 bins: int = THRESHOLDS.psi_bins, t: Thresholds = THRESHOLDS) -> DataFrame:
    """PSI per variable (4 decimals), its state, the sizes, and whether the batch as a whole alarms."""
    return with_batch_alert(psi_by_variable(reference, batch, columns, bins), t)


def with_batch_alert(psi: DataFrame, t: Thresholds = THRESHOLDS) -> DataFrame:
    """State from the unrounded PSI, then the number of alarming variables of the batch."""
    report = psi.withColumn("estado", classify_psi(F.col("psi"), t))
    # One row per named variable: a single small window.
    alarms = F.count_if(F.col("estado") == "alerta").over(W.partitionBy())
    return report.withColumn("n_en_alerta", alarms).select(
        "variable",
        F.round("psi", 4).alias("psi"),
        "estado", "n_referencia", "n_lote", "n_en_alerta",
        (F.col("n_en_alerta") > 0).alias("alerta"),
    )


def target_drift(reference: DataFrame, batch: DataFrame, target: str, bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """PSI of the target, unrounded, with its state."""
    found = psi_by_variable(reference, batch, [target], bins)
    return found.withColumn("estado", classify_psi(F.col("psi")))


def split_drift_check(df: DataFrame, columns: Sequence[str], split: str = "split_flag", train: str = "train",
                      test: str = "test") -> DataFrame:
    """Did the time split itself move any distribution? PSI of the later against the earlier part."""
    found = psi_by_variable(df.filter(F.col(split) == train), df.filter(F.col(split) == test), columns)
    return found.select("variable", F.round("psi", 4).alias("psi"), classify_psi(F.col("psi")).alias("estado"))


def drift_history(report: DataFrame, target: DataFrame | None, batch: str) -> DataFrame:
    """Long history rows of one evaluation, target included, ready to append."""
    rows = report.select("variable", "psi", "estado", "n_referencia", "n_lote")
    if target is not None:
        rows = rows.unionByName(target.select(
            F.lit("objetivo_duracion").alias("variable"), "psi", "estado", "n_referencia", "n_lote"))
    return rows.select(
        F.current_timestamp().alias("evaluado_en"), F.lit(batch).alias("lote"),
        "variable", "psi", "estado", "n_referencia", "n_lote",
    )
