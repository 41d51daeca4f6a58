"""Sinks: full rebuilds, partitioned tables, growing histories and JSON summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Replace the table, schema included."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitioned(df: DataFrame, name: str, column: str, fmt: str = "parquet",
                          rebalance: bool = False) -> DataFrame:
    """Replace a table laid out by a low-cardinality column, for partition pruning.

    Tasks write straight to the partitions they hold rows of, which fits input that
    already arrives by time. Where every task holds rows of every partition, ``rebalance``
    shuffles once to files of the advisory size: it merges small ones and splits a
    partition value that holds most rows over many tasks.
    """
    rows = df.hint("rebalance", column) if rebalance else df
    (
        rows.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
        .partitionBy(column).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def append_history(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Append rows; columns unknown to the table are added, absent ones become NULL."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format(fmt).saveAsTable(name)
        return spark.table(name)
    known = spark.table(name).columns
    added = [f for f in df.schema if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    target = spark.table(name).schema
    aligned = df.select([
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target
    ])
    aligned.write.insertInto(name)
    return spark.table(name)


def write_summary_json(summary: DataFrame, path: str) -> DataFrame:
    """Write a one-row summary frame as JSON, so later steps can read it if present."""
    summary.coalesce(1).write.mode("overwrite").json(path)
    return summary
