"""Batches by day: read one batch, replace days or deliveries, and leave nothing of what they no longer hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental_batch(df: DataFrame, process_date: str, ts: str = "pickup_datetime", days: int = 7) -> DataFrame:
    """Rows of the ``days`` before ``process_date`` (that day excluded), with their day as ``fecha``.

    The condition is on the bare column, so it reaches the scan.
    """
    end = F.lit(process_date).cast("date")
    start = F.date_sub(end, days)
    kind = dict(df.dtypes)[ts]
    bounds = [b.cast(kind) for b in (start, end)]
    return df.filter((F.col(ts) >= bounds[0]) & (F.col(ts) < bounds[1])).withColumn("fecha", F.to_date(ts))


def batch_days(spark: SparkSession, process_date: str, days: int = 7) -> list[str]:
    """The days that a batch of ``process_date`` covers, with or without rows."""
    end = F.lit(process_date).cast("date")
    return [str(r.d) for r in spark.range(1).select(F.explode(F.sequence(
        F.date_sub(end, days), F.date_sub(end, 1))).alias("d")).collect()]


def partitions(spark: SparkSession, path: str, levels: int = 1) -> list[dict[str, str]]:
    """The partitions that a folder holds, as column values; one listing, no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *["*=*"] * levels]))
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
    names = [str(f.getPath().toString()).rsplit("/", levels)[1:] for f in found or []]
    return [dict(part.split("=", 1) for part in own) for own in names]


def clear_partitions(spark: SparkSession, path: str, gone: Callable[[dict[str, str]], bool], levels: int = 1) -> list[dict[str, str]]:
    """Delete the partitions for which ``gone`` holds, and return them."""
    cleared = [p for p in partitions(spark, path, levels) if gone(p)]
    for p in cleared:
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{k}={v}" for k, v in p.items()]]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return cleared


def write_partitions(batch: DataFrame, path: str, columns: list[str]) -> None:
    """Replace the partitions that the batch has rows of, and no others."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def replace_days(batch: DataFrame, path: str, day: str = "fecha", covered: list[str] | None = None) -> DataFrame:
    """Write a batch into day partitions, replacing the days it holds and emptying the others that it covers.

    ``covered`` are all days of the batch; one of them without a row loses its files. Running the same batch
    again gives the same files, so a repeated or retried run is harmless.
    """
    spark = batch.sparkSession
    write_partitions(batch, path, [day])
    if covered:
        held = {str(r[0]) for r in batch.select(day).distinct().collect()}  # at most the days of a batch
        clear_partitions(spark, path, lambda p: p[day] in covered and p[day] not in held)
    return spark.read.schema(batch.schema).parquet(path)
