"""Exact sets of ids as bitmaps: a table of (bucket, bits), 32 768 ids a row of 4 KiB.

A set of dense ids takes a bit each, so what was sent before is looked up by a join of bitmaps, and no sent row is
shuffled again. Null ids are in no set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_set(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """``bucket`` and ``bits`` of the distinct ids; partial bitmaps are built before the shuffle."""
    ids = rows.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias("id"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id"))
    return ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(bits.alias("bits"))


def union(*sets: DataFrame) -> DataFrame:
    """All ids of several sets, kept between runs."""
    every = sets[0]
    for more in sets[1:]:
        every = every.unionByName(more)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(ids: DataFrame) -> DataFrame:
    return ids.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def _holds(bits: Column, id_column: Column) -> Column:
    place = F.bitmap_bit_position(id_column).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(place, F.lit(8))
    return F.expr("1").cast("int").bitwiseAND(F.call_function("shiftright", byte, bit)) == 1


def without(rows: DataFrame, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """``rows`` whose id is not in the set; rows with a null id stay."""
    own = rows.withColumn("_bucket", F.bitmap_bucket_number(F.col(id_column).cast("bigint")))
    known = ids.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    found = own.join(known, "_bucket", "left")
    inside = F.coalesce(_holds(F.col("_bits"), F.col(id_column).cast("bigint")), F.lit(False))
    return found.where(~inside).select(*rows.columns)
