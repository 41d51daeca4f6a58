"""Sources: raw CSV, tables, parquet folders and JSON summaries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripstrata.config import RAW_COLUMNS, SCORING_ABSENT


def raw_columns(origin: str) -> list[str]:
    """Business columns of the ``train`` or ``scoring`` file."""
    if origin == "train":
        return list(RAW_COLUMNS)
    if origin == "scoring":
        return [c for c in RAW_COLUMNS if c not in SCORING_ABSENT]
    raise ValueError(f"unknown origin: {origin}")


def read_raw_csv(spark: SparkSession, path: str, columns: list[str], check_header: bool = True) -> DataFrame:
    """CSV with a header, every column as text, failing on the first malformed line."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("enforceSchema", str(not check_header).lower())
        .csv(path)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Managed table, or a parquet path when ``name`` holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def stats_from_summary(spark: SparkSession, path: str) -> DataFrame | None:
    """JSON summary of an earlier step, or None when that step has not run."""
    try:
        return spark.read.json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
