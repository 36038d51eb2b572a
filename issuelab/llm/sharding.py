"""Extendible hashing: shards named by hash-prefix bits, split only where they are too large.

A row's bucket at depth d is the first d bits of the MD5 of its key. The directory starts at depth 0; a
bucket over the byte limit splits on the next bit, any other is a shard. Bytes are added up once by a
prefix long enough for even splits; the levels above come from that narrow table, and buckets that are
still too large at its depth (skewed keys) are gone through again with more bits. Rows of one key that
alone exceed the limit cannot be told apart by bits; their bucket is dealt into numbered parts in order.

Defined results: a null key hashes as the empty string, a null payload has no bytes. Repeated rows go to
the same shard, unless it is dealt into parts. A single row over the limit has a shard (or part) of its
own. An empty table stays empty. Columns with the name of a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.llm.common import spare_name
from issuelab.operators.lookup import lookup_join
from issuelab.operators.ordering import running_totals
from issuelab.session import stage

BITS = 60
#: Bits beyond those that an even split needs, and bits added in each further round.
SPARE_BITS, ROUND_BITS = 4, 12


def key_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def _round(sizes: DataFrame, top: int, depth: int, limit: int) -> DataFrame:
    """For each prefix of ``depth`` bits its bucket: depth, prefix, bytes, rows, and whether it fits."""
    prefix = F.shiftright("bits", BITS - depth)
    fine = stage(sizes.groupBy(prefix.alias("fine")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")), "fine")
    at_level = fine.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(depth)))).withColumn(
        "prefix", F.expr(f"shiftright(fine, {depth} - depth)")
    )
    levels = at_level.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    levels = stage(levels, "levels")
    above = levels.where(F.col("bytes") > limit).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
    )
    own = levels.where((F.col("bytes") <= limit) | (F.col("depth") == depth))
    own = own.withColumn("parent", F.shiftright("prefix", 1))
    split = own.join(above, ["depth", "parent"], "left_semi")
    shards = split.unionByName(own.where(F.col("depth") == top)) if top < depth else own
    shards = shards.select("depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
    return at_level.select("fine", "depth", "prefix").join(shards, ["depth", "prefix"])


def assign(docs: DataFrame, key: str, payload: str, limit: int) -> DataFrame:
    """``docs`` with ``shard``, ``shard_bytes`` and ``shard_rows``."""
    bits, size = spare_name(docs, "bits"), spare_name(docs, "bytes")
    sized = docs.withColumns(
        {bits: key_bits(F.col(key)), size: F.coalesce(F.octet_length(F.col(payload)), F.lit(0)).cast("bigint")}
    )
    sizes = sized.groupBy(F.col(bits).alias("bits")).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
    sizes = stage(sizes, "sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total) / limit))))
    top, left, found = 0, sizes, None
    while True:
        got = stage(_round(left, top, depth, limit), "buckets")
        fits = got if depth == BITS else got.where(F.col("shard_bytes") <= limit)
        # Every key of this round with its bucket, or without one if it goes on to the next.
        part = lookup_join(
            left.withColumn("fine", F.shiftright("bits", BITS - depth)), fits, "fine", weight="shard_rows",
            spread_by=("bits",),
        )
        part = stage(part, "assigned")
        done = part.where(F.col("depth").isNotNull()).drop("fine")
        found = done if found is None else found.unionByName(done)
        left = part.where(F.col("depth").isNull()).select("bits", "bytes", "rows")
        if depth == BITS or left.isEmpty():
            break
        top, depth = depth, min(BITS, depth + ROUND_BITS)
    name = F.concat(F.lit("s"), F.when(F.col("depth") > 0, F.expr("lpad(bin(prefix), depth, '0')")).otherwise(""))
    places = found.select(
        F.col("bits").alias(bits), name.alias("shard"), "shard_bytes", "shard_rows", F.col("rows").alias("key_rows")
    )
    held = sized.select(F.struct(*docs.columns).alias("row"), bits, size)
    placed = lookup_join(held, places, bits, weight="key_rows", spread_by=(size,)).drop("key_rows")
    if depth == BITS and not found.where(F.col("shard_bytes") > limit).isEmpty():
        placed = _deal(placed, size, limit)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "shard_bytes", "shard_rows")]
    return placed.select(*[F.col("row")[c].alias(c) for c in kept], "shard", "shard_bytes", "shard_rows")


def _deal(placed: DataFrame, size: str, limit: int) -> DataFrame:
    """Rows of buckets that bits cannot split, dealt into parts that fit."""
    fits = F.col("shard_bytes") <= limit
    over = stage(placed.where(~fits).withColumn("_row", F.monotonically_increasing_id()), "overflow")
    largest = over.groupBy("shard").agg(F.max(size).alias("_largest"))
    room = F.greatest(F.lit(1), F.lit(limit) - F.col("_largest"))
    order = running_totals(over.select("shard", "_row", F.col(size).alias("_b")), ["_row"], ["_b"], ["shard"])
    parts = order.join(F.broadcast(largest), "shard")  # at most one shard for each ``limit`` bytes of one key
    parts = parts.select("_row", F.expr("_b_before").alias("_before"), room.alias("_room"))
    parts = parts.select("_row", F.floor(F.col("_before") / F.col("_room")).cast("bigint").alias("_part"))
    dealt = over.join(parts, "_row").withColumn("shard", F.concat("shard", F.lit("-"), F.col("_part").cast("string")))
    each = dealt.groupBy("shard").agg(F.sum(size).alias("b"), F.count("*").alias("n"))
    dealt = dealt.drop("shard_bytes", "shard_rows", "_row", "_part").join(each, "shard")
    dealt = dealt.withColumnsRenamed({"b": "shard_bytes", "n": "shard_rows"}).select(placed.columns)
    return placed.where(fits).unionByName(dealt)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; every shard fits its limit, so it is written by one task."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


def sharding_sql(limit: int, deepest: int = 30) -> str:
    """DuckDB SQL for documents whose shards need at most ``deepest`` bits."""
    return f"""
    WITH rows AS (
      SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS b,
        CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS bits
      FROM documents
    ), levels AS (
      SELECT d, bits >> ({BITS} - d) AS p, CAST(sum(b) AS BIGINT) AS shard_bytes, count(*) AS shard_rows
      FROM rows, (SELECT CAST(unnest(range(0, {deepest + 1})) AS INTEGER) AS d) GROUP BY ALL
    ), shards AS (
      SELECT l.* FROM levels l LEFT JOIN levels a ON a.d = l.d - 1 AND a.p = l.p >> 1
      WHERE l.shard_bytes <= {limit} AND (l.d = 0 OR a.shard_bytes > {limit})
    )
    SELECT doc_id, 's' || CASE WHEN d > 0 THEN lpad(bin(p), d, '0') ELSE '' END AS shard, shard_bytes, shard_rows
    FROM rows, shards WHERE bits >> ({BITS} - d) = p
    """
