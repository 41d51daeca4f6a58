"""Raw text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.config import FLAG_COLUMN, RAW_TYPES


def columns_to_type(present: list[str], types: dict[str, str] = RAW_TYPES) -> dict[str, str]:
    """The part of the type map whose columns are present."""
    return {column: types[column] for column in types if column in set(present)}


def map_flag(column: Column) -> Column:
    """Y/N text to 1/0; anything else becomes NULL rather than a silent zero."""
    code = F.upper(F.trim(column))
    return F.when(code == "Y", F.lit(1)).when(code == "N", F.lit(0)).cast("int")


def apply_types(df: DataFrame, types: dict[str, str] = RAW_TYPES, flag: str = FLAG_COLUMN) -> DataFrame:
    """Cast the present columns; text that does not parse becomes NULL, audit columns stay as they are."""
    casts = {c: F.col(c).try_cast(t) for c, t in columns_to_type(df.columns, types).items()}
    if flag in df.columns:
        casts[flag] = map_flag(F.col(flag))
    return df.withColumns(casts)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column with its type."""
    return df.sparkSession.createDataFrame(df.dtypes, "columna string, tipo string")
