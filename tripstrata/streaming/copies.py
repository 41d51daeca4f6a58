"""Row copies across batches: a Bloom filter of the row hashes of each stored day and delivery.

A filter is a run of bitmaps of 32,768 bits, one row each, built and tested with built-in bitmap functions. A new row
is compared with stored rows only where the filter of a delivery for its day has all of its bits, so that a delivery
without copies reads no stored hash at all. Filters are staged and grouped like any other table: none is held by one
task or by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per row and positions per hash: about one in eighty rows that are new is compared in vain.
BITS_PER_ROW, POSITIONS = 10, 4
BITMAP_BITS = 32_768


def bit_positions(row_hash: Column, bitmaps: Column, positions: int = POSITIONS) -> Column:
    """Places (from 0) of a hash in a filter of so many bitmaps."""
    return F.array(*[F.pmod(F.xxhash64(row_hash, F.lit(k)), bitmaps * BITMAP_BITS) for k in range(positions)])


def build_filters(rows: DataFrame, by: list[str], row_hash: str = "_row_hash", bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """(*by, bitmaps, bucket, bitmap): a filter for each value of ``by``, as large as its number of rows asks for."""
    sizes = rows.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * bits_per_row / BITMAP_BITS)).cast("long").alias("bitmaps"))
    # One row per filter, and a value of ``by`` may hold any share of the rows: sent to the rows, which stay where they are.
    bits = rows.select(*by, row_hash).join(F.broadcast(sizes), by).select(
        *by, "bitmaps", F.explode(F.array_distinct(bit_positions(F.col(row_hash), F.col("bitmaps")))).alias("bit"))
    # Bitmap functions count bits from 1.
    return bits.groupBy(*by, "bitmaps", F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bitmap"))


def has_bit(bitmap: Column, position: Column) -> Column:
    """Whether a bitmap has the bit at ``position`` (from 0; the lowest bit of a byte comes first)."""
    byte = F.conv(F.hex(F.substr(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)) % 2 == 1


def may_hold(rows: DataFrame, filters: DataFrame, day: str, by: list[str], row_hash: str = "_row_hash") -> DataFrame:
    """(*by, row_hash): for each row the stored parts of its day whose filter has all of its bits."""
    parts = filters.select(*by, "bitmaps").distinct()
    asked = rows.select(day, row_hash).join(parts, day)
    probes = asked.select(*by, row_hash, F.explode(F.array_distinct(bit_positions(F.col(row_hash), F.col("bitmaps")))).alias("bit"))
    probes = probes.withColumn("bucket", F.bitmap_bucket_number(F.col("bit") + 1))
    # A bucket without any bit has no row, so a missing one is a bit that is not set.
    found = probes.join(filters.select(*by, "bucket", "bitmap"), [*by, "bucket"], "left").withColumn(
        "set", F.coalesce(has_bit(F.col("bitmap"), F.col("bit") % BITMAP_BITS), F.lit(False)))
    return found.groupBy(*by, row_hash).agg(F.min("set").alias("set")).filter("set").drop("set")
