"""Target transforms, clipping and right-closed bands."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.config import DISTANCE_CUTS, THRESHOLDS


def duration_min(seconds: Column) -> Column:
    return seconds / 60.0


def log_target(seconds: Column) -> Column:
    return F.log1p(seconds)


def inverse_log_target(value: Column) -> Column:
    return F.expm1(value)


def clip(value: Column, low=THRESHOLDS.duration_min_s, high=THRESHOLDS.duration_max_s) -> Column:
    """Hold ``value`` inside the valid range; NULL stays NULL."""
    return F.when(value < low, F.lit(float(low))).when(value > high, F.lit(float(high))).otherwise(value)


def bucket_right_closed(value: Column, cuts: Sequence[float] = DISTANCE_CUTS, open_end: bool = True) -> Column:
    """Index of the band ``(lower, upper]`` holding ``value``, else NULL.

    The lowest edge belongs to no band. With ``open_end`` the last cut starts an endless band.
    """
    edges = [*cuts, math.inf] if open_end else list(cuts)
    band = F.when(value <= edges[0], F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        band = band.when(value.isNotNull() if math.isinf(upper) else value <= upper, F.lit(i))
    return band


def band_label(band: Column, cuts: Sequence[float], unit: str = "km") -> Column:
    """Text such as ``0-1 km`` for a band index."""
    labels = [f"{lo:g}-{hi:g} {unit}" for lo, hi in zip(cuts, cuts[1:])]
    return F.element_at(F.array(*[F.lit(x) for x in labels]), band + 1)


def category_codes(df: DataFrame, column: str, output: str) -> DataFrame:
    """Dense codes 0, 1, … in the order of the labels; NULL gets -1.

    Only the distinct labels are ordered, in one task: this is for a label with few
    values (a vendor, a flag), not for identifiers. No size is forced on the join.
    """
    labels = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_label")).agg(F.lit(1).alias("_one"))
    codes = labels.select("_label", (F.row_number().over(W.orderBy("_label")) - 1).alias(output))
    return (
        df.join(codes, F.col(column) == F.col("_label"), "left")
        .drop("_label")
        .withColumn(output, F.coalesce(output, F.lit(-1)))
    )
