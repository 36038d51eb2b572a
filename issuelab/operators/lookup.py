"""Joins of a large table to a keyed look-up table, safe when one key holds a large share of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.session import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 100
SPREAD = 1 << 14


def fits_broadcast(table: DataFrame, max_rows: int) -> bool:
    """Measured rows and bytes of a written table are within the bounds.

    Texts and binaries count by their bytes, nested values by their JSON text.
    """
    width = F.lit(0)
    for f in table.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(f.name)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(F.col(f.name))))
        else:
            size = F.lit(16)
        width = width + F.coalesce(size, F.lit(0)) + 8
    size = table.agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_BYTES


def _spare(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (in any case)."""
    known = {c.lower() for c in taken}
    while wanted.lower() in known:
        wanted = f"_{wanted}"
    return wanted


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    weight: str | None = None,
    spread_by: Sequence[Column | str] = (),
    broadcast_rows: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """Left join ``facts`` to ``table`` (one row per ``key``).

    The table is written once (unless it is read from a written one: ``staged``) and measured. If it is small it is
    broadcast (``broadcast_rows``: ``BROADCAST_ROWS``). Otherwise its ``HOT_KEYS`` heaviest keys (by ``weight``) are
    broadcast if they fit and matched first, those rows get spread-out keys that match nothing, and the rest go
    through one balanced shuffle join. Columns of any name are kept.
    """
    table = table if staged else stage(table, "lookup")
    values = [c for c in table.columns if c != key]
    if fits_broadcast(table, BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return facts.join(F.broadcast(table), key, "left").select(*facts.columns, *values)
    hot = None
    if weight is not None:
        hot = stage(table.orderBy(F.desc(weight), key).limit(HOT_KEYS), "hot")
    if hot is None or not fits_broadcast(hot, HOT_KEYS):  # adaptive execution splits skewed partitions
        return facts.join(table, key, "left").select(*facts.columns, *values)
    taken = [*facts.columns, *table.columns]
    hot_key, hot_values, join_key, cold_key, cold_values = (
        _spare(taken, c) for c in ("_hot", "_hot_values", "_join", "_cold", "_cold_values")
    )
    hot = hot.select(F.col(key).alias(hot_key), F.struct(*values).alias(hot_values))
    flagged = facts.join(F.broadcast(hot), F.col(key) == F.col(hot_key), "left")
    slot = F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(SPREAD)).cast("string")
    # Null keys match nothing either, so they are spread the same way.
    settled = F.col(hot_key).isNotNull() | F.col(key).isNull()
    flagged = flagged.withColumn(
        join_key,
        F.when(settled, F.concat(F.lit("s"), slot)).otherwise(F.concat(F.lit("k"), F.col(key).cast("string"))),
    )
    rest = table.select(
        F.concat(F.lit("k"), F.col(key).cast("string")).alias(cold_key), F.struct(*values).alias(cold_values)
    )
    joined = flagged.join(rest, F.col(join_key) == F.col(cold_key), "left")
    pick = [
        F.coalesce(F.col(f"{hot_values}.`{c}`"), F.col(f"{cold_values}.`{c}`")).alias(c) for c in values
    ]
    return joined.select(*facts.columns, *pick)
