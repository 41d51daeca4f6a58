"""Drift from a kept profile equals drift from both tables."""

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import drift, profile
from tripstrata.plans import monitoring

COLUMNS = ["a", "b", "c", "flag", "gone"]


@pytest.fixture(scope="module")
def samples(spark):
    n = F.col("id")
    reference = spark.range(3000).select(
        n, (n * 7919 % 1013 / 10).alias("a"), F.when(n % 5 != 0, n % 9).alias("b"), F.lit(None).cast("double").alias("c"),
        (n % 400 == 0).cast("int").alias("flag"), n.alias("gone"), (n % 71).alias("y"))
    batch = spark.range(800).select(n, (n * 31 % 1500 / 10 - 20).alias("a"), F.when(n % 3 != 0, n % 12).alias("b"),
                                    n.cast("double").alias("c"), F.lit(0).alias("flag"), (n % 90).alias("y"))
    return reference, batch


def rows(df):
    return sorted(tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_report_equals_that_of_both_tables(spark, samples, tmp_path):
    reference, batch = samples
    kept = profile.kept_profile(spark, str(tmp_path / "p"), lambda: reference, [*COLUMNS, "y"])
    assert rows(profile.drift_from_profile(kept, batch, COLUMNS)) == rows(drift.drift_report(reference, batch, COLUMNS))
    assert rows(profile.target_drift_from_profile(kept, batch, "y")) == rows(drift.target_drift(reference, batch, "y"))
    empty = profile.drift_from_profile(kept, batch.limit(0), COLUMNS)
    assert empty.count() == 0


def test_a_batch_reads_no_reference(spark, samples, tmp_path):
    reference, batch = samples
    for name, df in (("reference", reference), ("batch", batch)):
        df.write.parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in ("reference", "batch")]
    kept = profile.kept_profile(spark, str(tmp_path / "p"), lambda: stored[0], COLUMNS)
    report = profile.drift_from_profile(kept, stored[1], COLUMNS)
    assert {f.rsplit("/", 2)[-2] for f in report.inputFiles()} == {"p", "batch"}


def test_profiles_are_rebuilt_when_their_version_differs(spark, samples, tmp_path):
    reference, _ = samples
    path, asked = str(tmp_path / "p"), []

    def source(df):
        def give():
            asked.append(1)
            return df
        return give

    first = profile.kept_profile(spark, path, source(reference), COLUMNS, tag="1")
    kept = rows(first.select("variable", "bin", "n").fillna(-1))
    version = first.first().version
    # The same version is kept, whatever the rows are by now.
    again = profile.kept_profile(spark, path, source(reference.limit(10)), COLUMNS, tag="1")
    assert rows(again.select("variable", "bin", "n").fillna(-1)) == kept and len(asked) == 2
    for df, columns, bins, tag in ((reference, COLUMNS, 10, "2"), (reference, COLUMNS, 5, "1"), (reference, COLUMNS[:2], 10, "1"),
                                   (reference.withColumn("b", F.col("b").cast("double")), COLUMNS, 10, "1")):
        other = profile.kept_profile(spark, path, source(df), columns, bins, tag).first().version
        assert other != version
        version = other


def test_counts_of_batches_add_up(spark, samples, tmp_path):
    reference, batch = samples
    kept = profile.kept_profile(spark, str(tmp_path / "p"), lambda: reference, COLUMNS)
    parts = [profile.batch_counts(kept, batch.filter(F.col("id") % 3 == k)) for k in range(3)]
    merged = profile.merge_counts(*parts)
    assert rows(profile.psi_from_profile(kept, merged)) == rows(drift.psi_by_variable(reference, batch, COLUMNS))
    grown = profile.grown_profile(kept, merged)
    sizes = {r.variable: r.n for r in grown.groupBy("variable").agg(F.sum("n").alias("n")).collect()}
    assert sizes["a"] == 3800 and sizes["gone"] == 3000
    with pytest.raises(ValueError):
        profile.grown_profile(kept, merged.withColumn("version", F.lit("x")))


def test_weeks_are_kept_once(spark, samples, tmp_path):
    reference, batch = samples
    for part, name in ((0, "w1"), (1, "w2"), (0, "w1")):
        frames = monitoring.monitor_batch(batch.filter(F.col("id") % 2 == part), str(tmp_path / "p"), lambda: reference, COLUMNS, "y",
                                          counts_path=str(tmp_path / "counts"), name=name)
    assert rows(frames["acumulado"]) == rows(drift.drift_report(reference, batch, COLUMNS))
    assert rows(frames["deriva_objetivo"]) == rows(drift.target_drift(reference, batch.filter("id % 2 = 0"), "y"))
