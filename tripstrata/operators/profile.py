"""Drift against a kept reference: bin edges and counts per bin, stored once, so that a batch reads only itself.

A profile has one row per variable and bin (NULL for values above the highest edge), with the edges, the reference's count and
the version it was built for. Counts merge: those of several batches, or of a reference that grows, add up bin by bin as long
as the edges stay the same, so a week's counts can be kept and summed instead of read again.

The version covers the columns, their types, the number of bins and a tag of the reference (its cutoff, say, or the
snapshot of its table). A stored profile of another version is not used but rebuilt.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import THRESHOLDS, Thresholds
from tripstrata.operators.drift import classify_psi, long_values, psi_terms, reference_cuts, with_batch_alert, with_bin
from tripstrata.sources.staging import stage_table

SCHEMA = "variable string, version string, cortes array<double>, bin int, n long"


def profile_version(schema, columns: Sequence[str], bins: int = THRESHOLDS.psi_bins, tag: str = "") -> str:
    """What a profile was built for; a column that the schema lacks is named as such."""
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    known = [[c, kinds.get(c, "absent")] for c in sorted(set(columns))]
    return hashlib.sha256(json.dumps([known, bins, tag]).encode()).hexdigest()


def build_profile(reference: DataFrame, columns: Sequence[str], bins: int = THRESHOLDS.psi_bins, tag: str = "") -> DataFrame:
    """(variable, version, cortes, bin, n) of the reference's columns; a variable without any value has no row."""
    present = [c for c in columns if c in reference.columns]
    cuts = stage_table(reference_cuts(reference, present, bins), "cuts")
    counts = with_bin(long_values(reference, present), cuts, bins).groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    # One row per variable and bin on either side.
    return counts.join(cuts.select("variable", "cortes"), "variable").select(
        "variable", F.lit(profile_version(reference.schema, columns, bins, tag)).alias("version"), "cortes", F.col("bin").cast("int").alias("bin"), "n")


def read_profile(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored profile, or None where there is none."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def kept_profile(spark: SparkSession, path: str, reference: Callable[[], DataFrame], columns: Sequence[str],
                 bins: int = THRESHOLDS.psi_bins, tag: str = "") -> DataFrame:
    """The stored profile if its version is that of the reference's schema, columns, bins and tag; else a new one, stored.

    ``reference`` gives the frame; only its schema is looked at unless the profile has to be built.
    """
    source = reference()
    version = profile_version(source.schema, columns, bins, tag)
    stored = read_profile(spark, path)
    if stored is not None and not stored.isEmpty() and stored.filter(F.col("version") != version).isEmpty():
        return stored
    build_profile(source, columns, bins, tag).coalesce(1).write.mode("overwrite").parquet(path)
    return read_profile(spark, path)


def batch_counts(profile: DataFrame, batch: DataFrame, bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """(variable, version, bin, n) of a batch in the profile's bins. The batch is read once; the profile has a few rows per variable."""
    cuts = profile.groupBy("variable", "version").agg(F.any_value("cortes").alias("cortes"))
    known = [r["variable"] for r in cuts.select("variable").collect()]  # at most the named columns
    present = [c for c in known if c in batch.columns]
    if not present:
        return profile.select("variable", "version", "bin", "n").limit(0)
    counted = with_bin(long_values(batch, present), cuts.select("variable", "cortes"), bins).groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(cuts.select("variable", "version")), "variable").select(
        "variable", "version", F.col("bin").cast("int").alias("bin"), "n")


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Counts of several batches as those of one. Parts of different versions stay apart, as their bins differ."""
    whole = parts[0].select("variable", "version", "bin", "n")
    for part in parts[1:]:
        whole = whole.unionByName(part.select("variable", "version", "bin", "n"))
    return whole.groupBy("variable", "version", "bin").agg(F.sum("n").alias("n"))


def grown_profile(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """The profile with the counts of a batch that has joined the reference; edges stay. Counts of another version are refused."""
    versions = profile.select("version").distinct().unionByName(counts.select("version").distinct()).distinct().count()
    if versions > 1:
        raise ValueError("the counts belong to another version of the profile")
    edges = profile.groupBy("variable").agg(F.any_value("cortes").alias("cortes"))
    return merge_counts(profile, counts).join(edges, "variable").select("variable", "version", "cortes", "bin", "n")


def psi_from_profile(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """Unrounded PSI of every variable that the batch has, with the sizes: equal to a comparison of both tables."""
    present = counts.select("variable").distinct()
    both = profile.select("variable", "version", "bin", F.col("n").alias("ref"), F.lit(0).cast("long").alias("new")).join(
        present, "variable", "left_semi").unionByName(counts.select("variable", "version", "bin", F.lit(0).cast("long").alias("ref"), F.col("n").alias("new")))
    summed = both.groupBy("variable", "version", "bin").agg(F.sum("ref").alias("ref"), F.sum("new").alias("new"))
    return psi_terms(summed, ["variable", "version"], "ref", "new").drop("version")


def drift_from_profile(profile: DataFrame, batch: DataFrame, columns: Sequence[str], bins: int = THRESHOLDS.psi_bins,
                       t: Thresholds = THRESHOLDS) -> DataFrame:
    """The drift report of a batch, without reading the reference."""
    own = profile.filter(F.col("variable").isin(list(columns)))
    return with_batch_alert(psi_from_profile(own, batch_counts(own, batch, bins)), t)


def target_drift_from_profile(profile: DataFrame, batch: DataFrame, target: str, bins: int = THRESHOLDS.psi_bins) -> DataFrame:
    """PSI of the target, unrounded, with its state, without reading the reference."""
    own = profile.filter(F.col("variable") == target)
    return psi_from_profile(own, batch_counts(own, batch, bins)).withColumn("estado", classify_psi(F.col("psi")))
