"""Calendar columns and time-based splits."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.config import TEST, THRESHOLDS, TRAIN


def weekend_flag(day_of_week: Column) -> Column:
    """1 on day 1 (Sunday) and 7 (Saturday), else 0."""
    return F.when(day_of_week.isin(1, 7), 1).otherwise(0)


def temporal_features(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Hour, day of week (1 = Sunday), month and weekend flag of ``ts``."""
    return df.withColumns({
        "pickup_hour": F.hour(ts),
        "pickup_dayofweek": F.dayofweek(ts),
        "pickup_month": F.month(ts),
        "is_weekend": weekend_flag(F.dayofweek(ts)),
    })


def temporal_split(ts: str = "pickup_datetime", cutoff: str = THRESHOLDS.split_cutoff) -> Column:
    """``test`` from the cutoff day on, else ``train`` (also for an unknown time)."""
    return F.when(F.to_date(ts) >= F.lit(cutoff).cast("date"), F.lit(TEST)).otherwise(F.lit(TRAIN))


def forward_windows(first: str, last: str, count: int = 3) -> list[dict]:
    """Forward validation windows: train before a cut, validate up to the next one."""
    start, end = date.fromisoformat(first), date.fromisoformat(last)
    step = timedelta(days=(end - start).days // (count + 1))
    cuts = [(start + step * i).isoformat() for i in range(1, count + 2)]
    return [
        {"ventana": i, "entrena_hasta": cut, "valida_hasta": following}
        for i, (cut, following) in enumerate(zip(cuts, cuts[1:]), start=1)
    ]


def forward_windows_frame(spark: SparkSession, first: str, last: str, count: int = 3) -> DataFrame:
    """:func:`forward_windows` as rows."""
    return spark.createDataFrame(
        forward_windows(first, last, count), "ventana int, entrena_hasta string, valida_hasta string"
    )


def forward_split(df: DataFrame, windows: list[dict], ts: str = "pickup_datetime") -> DataFrame:
    """Rows of every window tagged ``train`` or ``valid``; a row may serve several windows."""
    day = F.to_date(ts)
    roles = [
        F.struct(
            F.lit(w["ventana"]).alias("ventana"),
            F.when(day < F.lit(w["entrena_hasta"]).cast("date"), "train")
            .when(day < F.lit(w["valida_hasta"]).cast("date"), "valid").alias("papel"),
        )
        for w in windows
    ]
    return df.withColumn("_w", F.explode(F.array(*roles))).filter("_w.papel IS NOT NULL").select(
        *df.columns, "_w.ventana", "_w.papel"
    )
