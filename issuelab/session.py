"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None

_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def get_session(app_name: str = "issuelab", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with UTC and adaptive execution; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Streams that remember every id keep their state on disk.
        **_STATE_STORE,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """All timestamp rules here are stated in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def use_disk_state(spark: SparkSession) -> None:
    """Streams started from now on keep their state on disk, whoever built the session.

    A query that goes on from a checkpoint keeps the state store that its checkpoint names.
    """
    for key, value in _STATE_STORE.items():
        spark.conf.set(key, value)


def staging_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session may fall back to a
    temporary folder; on a cluster a missing setting is an error.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="issuelab-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage so a lost executor cannot change what later steps see, and gives the optimizer exact
    sizes for its join choices.
    """
    spark = df.sparkSession
    path = new_staging_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more. Only folders below the staging root are touched."""
    root = staging_root(spark)
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not staged below {root}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
