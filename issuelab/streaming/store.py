"""Issue store: one current document per id on plain parquet.

``log/batch_id=N`` holds each micro-batch and is overwritten when a batch is replayed, so a retry
after a lost executor or a failed write leaves the same rows. ``base/<version>`` holds the compacted
state and ``base/CURRENT`` (a one-row table) says which version to read and which batches it covers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("through", T.LongType())]
)


def latest_per_id(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per id; partial aggregation keeps one row per id and task."""
    best = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy("id").agg(best.alias("r")).select("r.*")


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Upsert one micro-batch. Replaying the same batch changes nothing."""
    ties = [c for c in ("kafka_partition", "kafka_offset") if c in df.columns]
    rows = latest_per_id(df, ["updated_at", *ties])
    rows.write.mode("overwrite").parquet(f"{path}/log/batch_id={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _pointer(spark: SparkSession, path: str) -> tuple[int, int] | None:
    if not _exists(spark, f"{path}/base/CURRENT"):
        return None
    row = spark.read.schema(POINTER).parquet(f"{path}/base/CURRENT").orderBy(F.desc("version")).first()
    return (row["version"], row["through"]) if row else None


def _log(spark: SparkSession, path: str, after: int) -> DataFrame | None:
    if not _exists(spark, f"{path}/log"):
        return None
    return spark.read.parquet(f"{path}/log").where(F.col("batch_id") > after)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """One row per id: latest update, then latest batch."""
    pointer = _pointer(spark, path)
    log = _log(spark, path, pointer[1] if pointer else -1)
    if pointer is None and log is None:
        raise ValueError(f"no issue store at {path}")
    parts = [log] if log is not None else []
    if pointer is not None:
        base = spark.read.parquet(f"{path}/base/v={pointer[0]}")
        parts.append(base.withColumn("batch_id", F.lit(-1).cast("int")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_per_id(rows, ["updated_at", "batch_id"]).drop("batch_id")


def compact(spark: SparkSession, path: str, through: int) -> int:
    """Fold batches up to ``through`` into a new base version; readers switch with the pointer.

    The pointer goes no further than the last batch there is, so batches that arrive later are read.
    """
    pointer = _pointer(spark, path)
    version = (pointer[0] if pointer else 0) + 1
    after = pointer[1] if pointer else -1
    log = _log(spark, path, after)
    if log is None:
        raise ValueError(f"no batches at {path}")
    if through < after:
        raise ValueError(f"batches up to {after} are folded already")
    rows = log.where(F.col("batch_id") <= through)
    last = rows.agg(F.max("batch_id").cast("long")).first()[0]
    through = after if last is None else last
    if pointer is not None:
        base = spark.read.parquet(f"{path}/base/v={pointer[0]}")
        rows = rows.unionByName(base.withColumn("batch_id", F.lit(-1).cast("int")))
    current = latest_per_id(rows, ["updated_at", "batch_id"]).drop("batch_id")
    current.write.mode("overwrite").parquet(f"{path}/base/v={version}")
    mark = spark.range(1).select(
        F.lit(version).cast("long").alias("version"), F.lit(through).cast("long").alias("through")
    )
    mark.write.mode("append").parquet(f"{path}/base/CURRENT")
    return version


def handed_over(spark: SparkSession, path: str) -> int | None:
    """Batches that the history took, once it is through."""
    if not _exists(spark, f"{path}/handover/_SUCCESS"):
        return None
    return spark.read.schema("batches long").parquet(f"{path}/handover").first()["batches"]


def record_handover(spark: SparkSession, path: str) -> int:
    """Record that the history is through; batches written from now on are live ones."""
    log = _log(spark, path, -1)
    last = None if log is None else log.agg(F.max("batch_id").cast("long")).first()[0]
    count = 0 if last is None else last + 1
    spark.range(1).select(F.lit(count).cast("long").alias("batches")).write.mode("overwrite").parquet(f"{path}/handover")
    return count
