"""Exact order statistics and quantiles per group, without gathering a group in one task.

A quantile is the value at a rank of the sorted group. Two ways to find it, both exact:

* ``discrete``: columns with a bounded number of distinct values (whole seconds up to a
  limit, hours, counts). Equal values are counted first (partial sums in each task,
  exchanged by key *and* value); only the distinct values of a group are then ordered.
* ``continuous``: any column. A histogram per group, with steps proportional to the
  magnitude, finds the step that holds each rank; only rows of those steps are exchanged
  and cut into fine slots; only the slot that holds the rank is ordered. What one task
  sorts is a fraction of a fraction of a group, whatever the size of the group.

No sketch is merged in one place, so the cost does not grow with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripstrata.sources.staging import stage_table

STEPS_PER_OCTAVE = 512
SMALLEST_OCTAVE = -60
SLOTS = 4096

Rank = Callable[[Column], Column]


def magnitude_step(value: Column) -> Column:
    """Integer that never falls as ``value`` grows: signed logarithm in fixed steps."""
    size = F.least(F.greatest(F.abs(value), F.lit(2.0**SMALLEST_OCTAVE)), F.lit(2.0**1000))
    step = F.floor((F.log2(size) - SMALLEST_OCTAVE) * STEPS_PER_OCTAVE).cast("int")
    return F.when(value < 0, -step).otherwise(step)


def _join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join of ``left`` (alias ``r``) and ``right`` (alias ``t``) in which NULL keys meet.

    A key that one side can never lack is compared by plain equality, which hashes faster.
    """
    def equal(c):
        a, b = F.col(f"r.{c}"), F.col(f"t.{c}")
        return a.eqNullSafe(b) if left.schema[c].nullable and right.schema[c].nullable else a == b

    return left.alias("r").join(right.alias("t"), reduce(and_, [equal(c) for c in columns]))


def _qualified(alias: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(f"{alias}.{c}").alias(c) for c in columns]


def _rank_hits(counted: DataFrame, keys: list[str], order: list[str], ranks: Sequence[Rank]) -> DataFrame:
    """Rows of ``counted`` whose running count covers a wanted rank, with the rank left inside the row."""
    group = W.partitionBy(*keys)
    running = counted.withColumns({
        "_upto": F.sum("_n").over(group.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)),
        "_all": F.sum("_n").over(group),
    })
    wanted = [F.struct(F.lit(i).alias("pos"), rank(F.col("_all")).cast("bigint").alias("rank"))
              for i, rank in enumerate(ranks)]
    before = F.col("_upto") - F.col("_n")
    return (
        running.withColumn("_w", F.explode(F.array(*wanted)))
        .filter((F.col("_w.rank") >= before) & (F.col("_w.rank") < F.col("_upto")))
        .withColumn("_pos", F.col("_w.pos"))
        .withColumn("_left", F.col("_w.rank") - before)
        .drop("_w", "_upto")
    )


def _columns_by_position(hits: DataFrame, keys: list[str], names: Sequence[str]) -> DataFrame:
    picked = [F.max(F.when(F.col("_pos") == i, F.col("_v"))).alias(name) for i, name in enumerate(names)]
    return hits.groupBy(*keys).agg(F.max("_all").alias("n"), *picked)


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, ranks: Sequence[Rank], names: Sequence[str],
                     domain: str = "continuous", weight: str | None = None, steps: DataFrame | None = None) -> DataFrame:
    """Values at 0-based ``ranks`` (functions of the group size) of each group, and the size ``n``.

    NULL values are not counted. ``weight`` is for rows that already stand for several
    (value counts). ``steps`` is the histogram of the continuous search, if it is kept already: the keys, ``_step``,
    ``_n``, ``_low`` and ``_high``. The continuous search stages its two small intermediate
    tables, so it runs two jobs when called; whether the wanted steps are broadcast follows
    from their size on disk.
    """
    keys = list(keys)
    own_keys = keys or ["_all_rows"]
    group = [F.col(k) for k in keys] or [F.lit(0).alias("_all_rows")]
    taken = [F.col(value).alias("_v")] + ([F.col(weight).alias("_n")] if weight else [])
    rows = df.filter(F.col(value).isNotNull()).select(*group, *taken)
    if domain == "discrete":
        times = F.sum("_n") if weight else F.count(F.lit(1))
        counted = rows.groupBy(*own_keys, "_v").agg(times.alias("_n"))
        found = _rank_hits(counted, own_keys, ["_v"], ranks)
    elif domain == "continuous":
        if steps is not None and not keys:
            steps = steps.withColumn("_all_rows", F.lit(0))
        found = _narrowed(rows, own_keys, ranks, steps)
    else:
        raise ValueError(f"unknown domain: {domain}")
    result = _columns_by_position(found, own_keys, names)
    return result if keys else result.drop("_all_rows")


def _narrowed(rows: DataFrame, keys: list[str], ranks: Sequence[Rank], steps: DataFrame | None = None) -> DataFrame:
    weights = [c for c in rows.columns if c == "_n"]
    times = F.sum("_n") if weights else F.count(F.lit(1))
    rows = rows.withColumn("_v", F.col("_v").cast("double")).withColumn("_step", magnitude_step(F.col("_v")))
    if steps is None:
        steps = rows.groupBy(*keys, "_step").agg(times.alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    spans = stage_table(
        _rank_hits(steps, keys, ["_step"], ranks)
        .groupBy(*keys, "_step", "_low", "_high", "_all").agg(_wanted_here()),
        "spans",
    )
    # Rows of the steps that hold a rank, counted per distinct value.
    width = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    slot = F.coalesce(F.floor((F.col("_v") - F.col("_low")) / width * SLOTS).cast("int"), F.lit(0))
    cells = stage_table(
        _join(rows, spans.drop("_wanted", "_all"), [*keys, "_step"])
        .select(*_qualified("r", [*keys, "_step"]), "_v", slot.alias("_slot"), *weights)
        .groupBy(*keys, "_step", "_slot", "_v").agg(times.alias("_n")),
        "cells",
    )
    # The slot that holds each rank, then the value within the slot.
    slots = cells.groupBy(*keys, "_step", "_slot").agg(F.sum("_n").alias("_n"))
    in_slot = _covering(slots, spans.drop("_low", "_high"), [*keys, "_step"], "_slot")
    targets = in_slot.groupBy(*keys, "_step", "_slot", "_all").agg(_wanted_here())
    return _covering(cells, targets, [*keys, "_step", "_slot"], "_v")


def _wanted_here() -> Column:
    return F.collect_list(F.struct(F.col("_pos").alias("pos"), F.col("_left").alias("rank"))).alias("_wanted")


def _covering(counted: DataFrame, targets: DataFrame, place: list[str], order: str) -> DataFrame:
    """Rows of ``counted`` that cover a rank wanted at their place."""
    window = W.partitionBy(*place).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    carried = [c for c in counted.columns if c not in place]
    before = F.col("_upto") - F.col("_n")
    return (
        _join(counted, targets, place)
        .select(*_qualified("r", place), *carried, "_all", "_wanted")
        .withColumn("_upto", F.sum("_n").over(window))
        .withColumn("_w", F.explode("_wanted"))
        .filter((F.col("_w.rank") >= before) & (F.col("_w.rank") < F.col("_upto")))
        .withColumns({"_pos": F.col("_w.pos"), "_left": F.col("_w.rank") - before})
        .drop("_w", "_upto", "_wanted")
    )


def _interpolated(names: Sequence[str], probabilities: Sequence[float]) -> list[Column]:
    columns = []
    for name, p in zip(names, probabilities):
        place = F.lit(float(p)) * (F.col("n") - 1)
        share = place - F.floor(place)
        lower, upper = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        columns.append((lower + (upper - lower) * share).alias(name))
    return columns


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str],
              domain: str = "continuous", weight: str | None = None) -> DataFrame:
    """Quantiles with linear interpolation between neighbours, and the group size ``n``."""
    ranks, columns = [], []
    for name, p in zip(names, probabilities):
        ranks.append(lambda n, p=p: F.floor(F.lit(float(p)) * (n - 1)))
        ranks.append(lambda n, p=p: F.least(F.floor(F.lit(float(p)) * (n - 1)) + 1, n - 1))
        columns += [f"_{name}_lo", f"_{name}_hi"]
    found = order_statistics(df, keys, value, ranks, columns, domain, weight)
    return found.select(*keys, "n", *_interpolated(names, probabilities))


def lower_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                    names: Sequence[str], domain: str = "continuous", weight: str | None = None,
                    steps: DataFrame | None = None) -> DataFrame:
    """The smallest value that at least a share ``p`` of the group does not exceed, and the size ``n``."""
    ranks = [lambda n, p=p: F.greatest(F.ceil(F.lit(float(p)) * n) - 1, F.lit(0)) for p in probabilities]
    return order_statistics(df, keys, value, ranks, list(names), domain, weight, steps)


def quantile_cuts(df: DataFrame, keys: Sequence[str], value: str, bins: int = 10, domain: str = "continuous") -> DataFrame:
    """Bin edges of a reference sample: the minimum, the values at ranks ``floor(n·i/bins)`` and the maximum.

    ``cortes`` is sorted and free of repeats, so a column dominated by one value gets fewer bins.
    """
    ranks = [lambda n: F.lit(0)]
    ranks += [lambda n, i=i: F.floor(n * i / F.lit(bins)) for i in range(1, bins)]
    ranks += [lambda n: n - 1]
    names = [f"_c{i}" for i in range(bins + 1)]
    found = order_statistics(df, keys, value, ranks, names, domain)
    return found.select(*keys, "n", F.array_distinct(F.array(*names)).alias("cortes"))
