"""Demand as kept state: counts of values per day that batches replace and that add up to exact medians.

A day (of a delivery) is kept as the counts of its values per key, and as a histogram of those columns whose values
are too many to order at once. Counts of several days add up, so a batch replaces its own days and the medians of the
whole follow from the sums: no row of another day is read again, and nothing has to be taken back. Only keys whose
counts changed are computed again; those of the replaced and of the new rows are noted before anything is changed,
so a run that failed in between is made up for by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.operators.demand import demand_columns, join_keys
from tripstrata.operators.quantiles import lower_quantiles, magnitude_step
from tripstrata.sources.staging import drop_stage, stage_table
from tripstrata.streaming.incremental import clear_partitions, partitions, write_partitions

KEYS = ("pickup_cluster", "pickup_hour", "pickup_dayofweek")
COUNTED, STEPPED = ("passenger_count", "trip_duration"), "distancia_haversine_km"
#: Folders of the state, of the demand table made from it and of the keys that wait for it.
VALUES, STEPS, DEMAND, PENDING = "demand_values", "demand_steps", "demand", "demand_pending"
#: Fixed value: the name of a folder for NULL in partitioned tables.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def state_values(rows: DataFrame, days: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(days, keys, nombre, paso, valor, n): how often each value occurs; ``paso`` is the step of a stepped column, else NULL.

    NULL values are counted as such, so the counts of any one column add up to the rows.
    """
    named = F.array(*[F.struct(F.lit(c).alias("nombre"), F.col(c).cast("double").alias("valor")) for c in (*COUNTED, STEPPED)])
    long = rows.select(*days, *keys, F.explode(named).alias("v")).select(*days, *keys, "v.*")
    step = F.when((F.col("nombre") == STEPPED) & F.col("valor").isNotNull(), magnitude_step(F.col("valor")))
    return long.groupBy(*days, *keys, "nombre", step.alias("paso"), "valor").agg(F.count(F.lit(1)).alias("n"))


def state_steps(values: DataFrame, days: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """(days, keys, paso, n, desde, hasta): the histogram of the stepped column."""
    return _histogram(values.filter(F.col("paso").isNotNull()), [*days, *keys], "valor", "valor")


def _histogram(counts: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    return counts.groupBy(*keys, "paso").agg(F.sum("n").alias("n"), F.min(low).alias("desde"), F.max(high).alias("hasta"))


def merged_demand(values: DataFrame, steps: DataFrame, keys: Sequence[str] = KEYS, seconds: T.DataType | None = None) -> DataFrame:
    """The table of :func:`~tripstrata.operators.demand.demand_aggregate` from the state of any days, equal to it on their rows.

    ``steps`` say where a median lies; of the stepped values only those of that step are exchanged. Two jobs run when
    this is called.
    """
    keys = list(keys)

    def own(name):
        return values.filter((F.col("nombre") == name) & F.col("valor").isNotNull())

    counted = values.filter(F.col("nombre") == COUNTED[0]).groupBy(*keys).agg(
        F.sum("n").alias("n_viajes"),
        F.round(F.try_divide(F.sum(F.col("valor") * F.col("n")), F.sum(F.when(F.col("valor").isNotNull(), F.col("n")))), 2)
        .alias("pasajeros_promedio"))
    duration = lower_quantiles(own(COUNTED[1]), keys, "valor", [0.5], ["duracion_mediana_seg"], "discrete", weight="n")
    merged = _histogram(steps, keys, "desde", "hasta")
    distance = lower_quantiles(own(STEPPED), keys, "valor", [0.5], ["distancia_mediana_km"], weight="n",
                               steps=merged.withColumnsRenamed({"paso": "_step", "n": "_n", "desde": "_low", "hasta": "_high"}))
    found = join_keys(join_keys(counted, duration.drop("n"), keys), distance.drop("n"), keys)
    kind = seconds or T.LongType()
    return demand_columns(found.withColumn("duracion_mediana_seg", F.col("duracion_mediana_seg").cast(kind)), keys)


def only_keys(table: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``table`` whose key is (``left_semi``) or is not (``left_anti``) in ``wanted``; NULL keys meet."""
    other = wanted.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return table.join(other, same, how)


def update_demand(analytics: DataFrame, folder: str, touched: Callable[[dict[str, str]], bool], days: Sequence[str] = ("fecha", "lote"),
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """Bring the state and the demand table in ``folder`` up to the stored ``analytics``, after a batch replaced partitions of it.

    ``touched`` tells the partitions that the batch may have replaced or emptied; all others are taken as they are kept.
    Of the demand table, only the keys that have or had rows in them are computed anew, and only the parts of the table
    (by its last key) that hold such keys are written. Running it again gives the same files. Returns the demand table.
    """
    spark, days, keys = analytics.sparkSession, list(days), list(keys)
    kinds = {f.name: f.dataType for f in analytics.schema}
    place = ", ".join(f"{c} {kinds[c].simpleString()}" for c in [*keys, *days])
    value_schema, step_schema = f"nombre string, paso int, valor double, n long, {place}", f"paso int, n long, desde double, hasta double, {place}"

    def stored(name, schema):
        return spark.read.schema(schema).parquet(f"{folder}/{name}")

    def parts(name):
        return {tuple(p[d] for d in days) for p in partitions(spark, f"{folder}/{name}", len(days)) if touched(p)}

    def of(frame, wanted):
        # One condition per day and delivery of the batch, so only their folders are read.
        chosen = F.lit(False)
        for part in sorted(wanted):
            own = F.lit(True)
            for d, v in zip(days, part):
                own = own & (F.col(d) == F.lit(v).cast(kinds[d]))
            chosen = chosen | own
        return frame.filter(chosen)

    before, now = parts(VALUES), parts("analytics")
    fresh = stage_table(state_values(of(analytics, now), days, keys), "demand-state")
    changed = fresh.select(*keys).distinct()
    if before:
        changed = changed.unionByName(of(stored(VALUES, value_schema), before).select(*keys)).distinct()
    changed.write.mode("append").parquet(f"{folder}/{PENDING}")

    # Values of a key lie together, so a read of few keys or of one column skips the other blocks; a day can span tasks.
    order = [*days, "nombre", *keys, "paso", "valor"]
    with ThreadPoolExecutor(1) as pool:
        steps = pool.submit(inheritable_thread_target(write_partitions), state_steps(fresh, days, keys), f"{folder}/{STEPS}", days)
        write_partitions(fresh.repartitionByRange(*order).sortWithinPartitions(*order), f"{folder}/{VALUES}", days)
        steps.result()
    held = set(now)
    for name in (VALUES, STEPS):
        clear_partitions(spark, f"{folder}/{name}", lambda p: touched(p) and tuple(p[d] for d in days) not in held, len(days))
    drop_stage(fresh)

    wanted = stage_table(spark.read.schema(", ".join(f"{k} {kinds[k].simpleString()}" for k in keys)).parquet(f"{folder}/{PENDING}")
                         .distinct(), "demand-keys")
    anew = merged_demand(only_keys(stored(VALUES, value_schema), wanted, keys), only_keys(stored(STEPS, step_schema), wanted, keys),
                         keys, kinds[COUNTED[1]])
    slot = keys[-1]
    table = anew
    if partitions(spark, f"{folder}/{DEMAND}"):
        kept = spark.read.schema(anew.schema).parquet(f"{folder}/{DEMAND}")
        in_reach = only_keys(kept, wanted.select(slot).distinct(), [slot])
        table = only_keys(in_reach, wanted, keys, "left_anti").unionByName(anew)
    table = stage_table(table, "demand-table")
    write_partitions(table, f"{folder}/{DEMAND}", [slot])
    # Values of the last key; each is a folder of the table.
    rest, reach = ({NULL_PART if r[0] is None else str(r[0]) for r in f.select(slot).distinct().collect()} for f in (table, wanted))
    clear_partitions(spark, f"{folder}/{DEMAND}", lambda p: p[slot] in reach and p[slot] not in rest)
    drop_stage(table)
    drop_stage(wanted)
    pending = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{PENDING}")
    pending.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(pending, True)
    return spark.read.schema(anew.schema).parquet(f"{folder}/{DEMAND}").select(anew.columns)
