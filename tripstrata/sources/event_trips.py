"""Trips derived from a generic event table, for checks and timings without a trip file.

Coordinates lie on a grid of thousandths of a degree and are built as text from integer
parts, so any SQL engine derives exactly the same raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import RAW_COLUMNS

# The event days run from 2024-01-01 to 2024-01-30; the last week is the test period.
SPLIT_CUTOFF = "2024-01-24"
FIRST_DAY = "2024-01-01"


def _degrees(thousandths: Column, sign: str = "") -> Column:
    return F.concat(
        F.lit(sign), F.floor(thousandths / 1000).cast("string"), F.lit("."),
        F.lpad((thousandths % 1000).cast("string"), 3, "0"),
    )


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trips (all text) derived from ``event_id``, ``user_id`` and ``ts``."""
    e, u = F.col("event_id"), F.col("user_id")
    grid = events.select(
        e.alias("event_id"), u.alias("user_id"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"),
        ((u * 37 + e * 13) % 300).alias("a"), ((u * 53 + e * 29) % 300).alias("b"),
        ((u * 71 + e * 17) % 300).alias("c"), ((u * 11 + e * 41) % 300).alias("d"),
    )
    busy = F.when(F.hour("t").between(7, 19), 240).otherwise(0)
    seconds = F.when(e % 997 == 0, F.lit(86391)).otherwise(
        60 + 9 * (F.abs(F.col("a") - F.col("c")) + F.abs(F.col("b") - F.col("d"))) + (e * 7919) % 300 + busy)
    timed = grid.withColumn("s", seconds.cast("bigint"))
    lost_pickup, lost_dropoff = e % 419 == 0, e % 211 == 0
    stamp = "yyyy-MM-dd HH:mm:ss"

    def coordinate(lost, thousandths, sign=""):
        return F.when(lost, F.lit("0.0")).otherwise(_degrees(thousandths, sign))

    values = {
        "id": F.concat(F.lit("id"), e.cast("string")),
        "vendor_id": (u % 2 + 1).cast("string"),
        "pickup_datetime": F.date_format("t", stamp),
        "dropoff_datetime": F.date_format(F.timestamp_seconds(F.unix_timestamp("t") + F.col("s")), stamp),
        "passenger_count": F.when(e % 97 == 0, F.lit(0)).otherwise(1 + (e * 31) % 6).cast("string"),
        "pickup_longitude": coordinate(lost_pickup, F.lit(74050) - F.col("b"), "-"),
        "pickup_latitude": coordinate(lost_pickup, F.lit(40600) + F.col("a")),
        "dropoff_longitude": coordinate(lost_dropoff, F.lit(74050) - F.col("d"), "-"),
        "dropoff_latitude": coordinate(lost_dropoff, F.lit(40600) + F.col("c")),
        "store_and_fwd_flag": F.when(e % 179 == 0, "Y").otherwise("N"),
        "trip_duration": F.col("s").cast("string"),
    }
    return timed.select(*[values[c].alias(c) for c in RAW_COLUMNS])


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips of a data folder, as its files are split."""
    return raw_trips_from_events(spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id", "ts"))
