"""Audit columns and load checks of the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_MARK = "<null>"
HASH_SEPARATOR = "||"


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over business columns. NULLs are marked, since ``concat_ws`` skips them."""
    marked = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *marked), 256)


def with_audit(df: DataFrame, columns: list[str], source_file: str, origin: str) -> DataFrame:
    """Ingest time, source file, origin and row hash."""
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_source_file": F.lit(source_file),
        "_origen": F.lit(origin),
        "_row_hash": row_hash(columns),
    })


def load_check(df: DataFrame, key: str = "id", hash_col: str = "_row_hash", expected: int | None = None) -> DataFrame:
    """Rows, distinct hashes, distinct keys, both kinds of duplicates and the expected count.

    Rows are counted once per (key, hash); keys and hashes are then folded from those counts, each by
    itself, so the hash need not cover the key. Copies collapse before each exchange, the first
    exchange serves both, and no distinct aggregate has to expand the rows.
    """
    per_pair = df.groupBy(key, hash_col).agg(F.count(F.lit(1)).alias("rows"))
    hashes = per_pair.groupBy(hash_col).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_hash"))
    totals = per_pair.groupBy(key).agg(F.sum("rows").alias("rows")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_filas"),
        F.count(F.lit(1)).alias("n_ids"),
    ).withColumn("n_hash", hashes.scalar())
    return totals.select(
        "n_filas",
        "n_hash",
        "n_ids",
        (F.col("n_filas") - F.col("n_hash")).alias("duplicados_exactos"),
        (F.col("n_filas") - F.col("n_ids")).alias("ids_repetidos"),
        F.lit(expected).cast("bigint").alias("filas_esperadas"),
        (F.lit(expected).cast("bigint").isNull() | (F.col("n_filas") == F.lit(expected))).alias("conteo_correcto"),
    )


def assert_loaded(check: DataFrame) -> dict:
    """Fail when the loaded row count is not the expected one."""
    row = check.first().asDict()
    if not row["conteo_correcto"]:
        raise ValueError(f"unexpected row count: {row['n_filas']} loaded, {row['filas_esperadas']} expected")
    return row
