"""Running totals over long tables, rank comparison, sampling and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import THRESHOLDS
from tripstrata.sources.staging import stage_table


def running_total(df: DataFrame, order: Sequence[Column], amount: str, output: str) -> DataFrame:
    """Running sum over the whole ordered table without one task seeing all of it.

    The rows are range-partitioned and staged with the number of their range, so the
    ranges stay the same however often a task is repeated. The sum before each range
    comes from one total per range.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = stage_table(ranged, "ranges")
    totals = ranged.groupBy("_range").agg(F.sum(amount).alias("_sum"))
    before = totals.select(
        "_range", (F.sum("_sum").over(W.orderBy("_range")) - F.col("_sum")).alias("_before")
    )
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # At most one row per shuffle partition.
    return (
        ranged.join(F.broadcast(before), "_range")
        .withColumn(output, F.col("_before") + F.sum(amount).over(inside))
        .drop("_range", "_before")
    )


def rank_compare(expected: DataFrame, obtained: DataFrame, item: str = "factor", position: str = "pos") -> DataFrame:
    """Positions of the items found in both orderings. Both frames hold ``item`` and a 1-based ``position``."""
    return expected.select(item, F.col(position).alias("prevista")).join(
        obtained.select(item, F.col(position).alias("obtenida")), item)


def rank_agreement(compared: DataFrame) -> DataFrame:
    """Correlation of the two positions over the common items."""
    return compared.agg(F.corr("prevista", "obtenida").alias("concordancia"))


def positions(df: DataFrame, item: str, by: str) -> DataFrame:
    """1-based position of each item, largest ``by`` first. For short lists such as the features of a model."""
    return df.select(item, F.row_number().over(W.orderBy(F.desc(by), F.col(item))).alias("pos"))


def union_parts(*parts: DataFrame) -> DataFrame:
    """All rows of the parts, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def sample_fraction(df: DataFrame, fraction: float, seed: int = THRESHOLDS.seed, limit: int | None = None) -> DataFrame:
    """Random sample without replacement; with ``limit`` at most so many of its rows."""
    drawn = df.sample(fraction=fraction, seed=seed)
    return drawn if limit is None else drawn.limit(limit)


def hash_share(key: Column, salt: str = "") -> Column:
    """A number in [0, 1) that depends only on the key and the salt: the same on every run and layout."""
    digest = F.sha2(F.concat(key.cast("string"), F.lit(salt)), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def sample_by_key(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Sample chosen by the key alone, so it does not change with partitioning or retries."""
    return df.filter(hash_share(F.col(key), salt) < fraction)


def sample_rows(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer) chosen by the key alone. Every task keeps its own first ``rows``."""
    return df.orderBy(hash_share(F.col(key)), key).limit(rows)
