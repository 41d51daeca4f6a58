"""Effect sizes, simple regression, distribution shape, dispersion and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.config import DISPERSION_CUTS
from tripstrata.functions.numeric import band_label, bucket_right_closed
from tripstrata.operators.quantiles import lower_quantiles, quantiles
from tripstrata.sources.staging import stage_table


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct inside the plan of another frame: no join, no trip to the driver."""
    return df.select(F.struct("*").alias("row")).scalar()


def _ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0 where the divisor is 0 or missing."""
    return F.coalesce(F.when(whole != 0, part / whole), F.lit(0.0))


def regression_moments(df: DataFrame, x: str, y: str) -> DataFrame:
    """Count, means, variances and covariance of the pairs where both are known."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mx"), F.avg(y).alias("my"),
        F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"),
        F.covar_pop(x, y).alias("cov"),
    )


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares of ``y`` on ``x``: intercept, slope and r². All 0 when ``x`` does not vary."""
    return (
        regression_moments(df, x, y)
        .withColumn("pendiente", _ratio(F.col("cov"), F.col("vx")))
        .select(
            F.when(F.col("vx") != 0, F.col("my") - F.col("pendiente") * F.col("mx"))
            .otherwise(F.lit(0.0)).alias("intercepto"),
            "pendiente",
            _ratio(F.col("cov") * F.col("cov"), F.col("vx") * F.col("vy")).alias("r2"),
        )
    )


def with_residual(df: DataFrame, x: str, y: str, output: str = "residuo") -> DataFrame:
    """``y`` less its linear fit on ``x``; the coefficients stay in the plan as a one-row subquery."""
    fit = one_row(simple_regression(df, x, y))
    return (
        df.withColumn("_fit", fit)
        .withColumn(output, F.col(y) - (F.col("_fit.intercepto") + F.col("_fit.pendiente") * F.col(x)))
        .drop("_fit")
    )


def _between_shares(df: DataFrame, factors: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Share of variance between the levels of each factor, for several values at once.

    One pass over the rows keeps count, mean and centred squares per level; the total
    is put together from those, so no sum of raw squares can cancel. A level of any
    weight collapses inside each task before the exchange. The levels are staged, since
    they are read for the mean of each factor and again for the spread around it.
    """
    long = df.select(*[F.col(f).cast("string").alias(f) for f in factors], *[F.col(v).alias(f"_v_{v}") for v in values])
    long = long.unpivot([f"_v_{v}" for v in values], list(factors), "factor", "nivel")
    levels = stage_table(long.groupBy("factor", "nivel").agg(*[
        stat for v in values for stat in (
            F.count(f"_v_{v}").alias(f"n_{v}"), F.avg(f"_v_{v}").alias(f"m_{v}"), F.var_pop(f"_v_{v}").alias(f"s_{v}")
        )
    ]), "levels")
    totals = levels.groupBy("factor").agg(*[
        stat for v in values for stat in (
            (F.sum(F.col(f"n_{v}") * F.col(f"m_{v}")) / F.nullif(F.sum(f"n_{v}"), F.lit(0))).alias(f"g_{v}"),
            F.sum(F.col(f"n_{v}") * F.col(f"s_{v}")).alias(f"w_{v}"),
        )
    ])
    # One row per named factor.
    joined = levels.join(F.broadcast(totals), "factor")
    between = {v: F.sum(F.col(f"n_{v}") * F.pow(F.col(f"m_{v}") - F.col(f"g_{v}"), 2)) for v in values}
    return joined.groupBy("factor").agg(*[
        _ratio(between[v], between[v] + F.first(f"w_{v}")).alias(v) for v in values
    ])


def eta_squared(df: DataFrame, value: str, group: str) -> DataFrame:
    """Share of the variance of ``value`` that the groups explain, 0 when it does not vary."""
    return _between_shares(df, [group], [value]).select(F.col("factor"), F.col(value).alias("eta2"))


def effect_table(df: DataFrame, value: str, residual: str, factors: Sequence[str]) -> DataFrame:
    """Marginal and partial eta² of every factor, largest partial effect first."""
    return (
        _between_shares(df, factors, [value, residual])
        .select(
            "factor",
            F.round(value, 6).alias("eta2_marginal"),
            F.round(residual, 6).alias("eta2_parcial"),
        )
        .orderBy(F.desc("eta2_parcial"), "factor")
    )


def distribution_shape(df: DataFrame, value: str, domain: str = "continuous", scale: float = 60.0) -> DataFrame:
    """Mean, median, 90th percentile (divided by ``scale``), skewness and excess kurtosis, raw and log1p."""
    log = F.log1p(value)
    middle = one_row(lower_quantiles(df, [], value, [0.5, 0.9], ["p50", "p90"], domain))
    return (
        df.agg(
            (F.avg(value) / scale).alias("media_min"),
            F.skewness(value).alias("asimetria"),
            F.kurtosis(value).alias("curtosis"),
            F.skewness(log).alias("asimetria_log"),
            F.kurtosis(log).alias("curtosis_log"),
        )
        .withColumn("_q", middle)
        .select(
            "media_min",
            (F.col("_q.p50") / scale).alias("mediana_min"),
            (F.col("_q.p90") / scale).alias("p90_min"),
            "asimetria", "curtosis", "asimetria_log", "curtosis_log",
        )
    )


def band_dispersion(df: DataFrame, band_by: str, value: str, cuts: Sequence[float] = DISPERSION_CUTS,
                    minimum: int = 100, scale: float = 60.0, domain: str = "continuous", unit: str = "km") -> DataFrame:
    """p10, p50, p90, their spread and ratio of ``value`` per band; thin bands are left out."""
    banded = df.withColumn("_band", bucket_right_closed(F.col(band_by), cuts, open_end=False)).filter(
        "_band IS NOT NULL")
    found = quantiles(banded, ["_band"], value, [0.1, 0.5, 0.9], ["p10", "p50", "p90"], domain)
    return (
        found.filter(F.col("n") >= minimum)
        .select(
            band_label(F.col("_band"), cuts, unit).alias("tramo"),
            "n",
            *[(F.col(p) / scale).alias(p) for p in ("p10", "p50", "p90")],
            ((F.col("p90") - F.col("p10")) / scale).alias("ancho"),
            _ratio(F.col("p90"), F.col("p10")).alias("razon"),
        )
    )


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Correlation of each named pair, all in one pass."""
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return wide.unpivot([], wide.columns, "par", "r").select(
        F.split_part("par", F.lit("|"), F.lit(1)).alias("a"),
        F.split_part("par", F.lit("|"), F.lit(2)).alias("b"),
        "r",
    )
