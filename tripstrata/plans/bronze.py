"""Raw layer: load the file as it is, add audit columns, check what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstrata.config import TABLES, TableNames
from tripstrata.sources.audit import assert_loaded, load_check, with_audit
from tripstrata.sources.readers import raw_columns, read_raw_csv
from tripstrata.sources.writers import overwrite_table


def create_schemas(spark: SparkSession, tables: TableNames = TABLES) -> None:
    for schema in tables.schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def bronze_frame(raw: DataFrame, source_file: str, origin: str = "train") -> DataFrame:
    columns = [c for c in raw.columns if not c.startswith("_")]
    return with_audit(raw, columns, source_file, origin)


def run_bronze(spark: SparkSession, path: str, origin: str = "train", expected: int | None = None,
               tables: TableNames = TABLES) -> dict:
    """CSV file to raw table; fails when the row count is not the expected one."""
    create_schemas(spark, tables)
    name = tables.raw_trips if origin == "train" else tables.raw_scoring
    raw = read_raw_csv(spark, path, raw_columns(origin))
    written = overwrite_table(bronze_frame(raw, path.rsplit("/", 1)[-1], origin), name)
    return assert_loaded(load_check(written, expected=expected))
