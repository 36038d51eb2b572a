"""Scans of issue data."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.functions.timing import parse_utc
from issuelab.schemas import ISSUE_RAW
from issuelab.session import use_utc
from issuelab.sources import export

DUMP_PATTERN = "*.{json,jsonl,ndjson}"


#: Local paths come as ``file:/x`` or ``file:///x``.
_SLASHES = re.compile("^file:/+")


def _local(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def arrival_order() -> Column:
    """Sortable position of a scanned row: file, place in the file, row in the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_jsonl(
    spark: SparkSession,
    root: str,
    schema: T.StructType = ISSUE_RAW,
    with_order: bool = True,
    pattern: str = "*.jsonl",
    only: Sequence[str] | None = None,
) -> DataFrame:
    """All JSON-lines files below ``root``; blank lines are skipped, a malformed line fails the job.

    ``only``: read these files (as ``inputFiles`` names them) and open no others.
    """
    use_utc(spark)
    df = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("mode", "FAILFAST")
        .json(root)
    )
    if only is not None:
        df = df.where(_local(F.col("_metadata.file_path")).isin([_SLASHES.sub("file:/", f) for f in only]))
    return df.select("*", arrival_order().alias("ingest_seq")) if with_order else df


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A document-store export without its internal key, with each row's place in it."""
    use_utc(spark)
    df = spark.read.parquet(path)
    if "ingest_seq" not in df.columns:
        df = df.select("*", arrival_order().alias("ingest_seq"))
    return df.drop("_id")


def read_collection(spark: SparkSession, uri: str, database: str, collection: str) -> DataFrame:
    """A document-store collection; needs the store's Spark connector on the class path."""
    use_utc(spark)
    return (
        spark.read.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .load()
        .drop("_id")
        .withColumn("ingest_seq", F.monotonically_increasing_id())
    )


def read_export(spark: SparkSession, path: str, schema: T.StructType = ISSUE_RAW, split_bytes: int = export.SPLIT_BYTES) -> DataFrame:
    """A binary export of a document store, without its internal key, with each document's place."""
    use_utc(spark)
    export.register(spark)
    fields = [f for f in schema if f.name != "_id"]
    place = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType())])
    full = T.StructType([*fields, T.StructField(export.PLACE, place)])
    df = spark.read.format(export.FORMAT).schema(full).option("splitBytes", split_bytes).load(path)
    return df.withColumnRenamed(export.PLACE, "ingest_seq")


def read_training(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    use_utc(spark)
    df = spark.read.parquet(path)
    missing = [c for c in ("row_id", "created_ts", "days_to_close") if c not in df.columns]
    if missing:
        raise ValueError(f"training table lacks {missing}")
    return df.select(*columns) if columns else df


def _first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in candidates:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p) and fs.getFileStatus(p).isDirectory():
            return path
    return candidates[0]


def load_issues(spark: SparkSession, source: str, location: str | Sequence[str], **store: str) -> DataFrame:
    """Raw issues from ``jsonl`` (first existing folder of the candidates), ``store``, ``export`` or ``mongo``."""
    if source == "jsonl":
        candidates = [location] if isinstance(location, str) else list(location)
        df = read_jsonl(spark, _first_existing(spark, candidates))
    elif source == "store":
        df = read_store(spark, location)
    elif source == "export":
        df = read_export(spark, location)
    elif source == "mongo":
        df = read_collection(spark, location, store["database"], store["collection"])
    else:
        raise ValueError(f"unknown source {source!r}")
    if df.isEmpty():
        raise ValueError(f"no records in {source} {location}")
    return df


def read_sample(
    spark: SparkSession, path: str, rows: int = 100_000, schema: T.StructType = ISSUE_RAW, **kw
) -> DataFrame:
    """First rows of a JSON-lines dump in file order.

    Files are opened in the order of their names, twice as many at a time, until they hold enough rows.
    """
    files = sorted(read_jsonl(spark, path, schema, **kw).inputFiles())
    taken = 1
    while True:
        df = read_jsonl(spark, path, schema, only=files[:taken], **kw)
        if taken >= len(files) or df.limit(rows).count() >= rows:
            return df.orderBy("ingest_seq").limit(rows).drop("ingest_seq")
        taken *= 2


def line_counts(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """Lines per file, blank ones included."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
    )
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))


def dashboard_issues(df: DataFrame) -> DataFrame:
    """Typed dates and comma-joined labels; an absent label column is empty text."""
    dates = {
        c: parse_utc(c)
        for c in ("created_at", "closed_at")
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)
    }
    if "labels" not in df.columns:
        joined = F.lit("")
    elif isinstance(df.schema["labels"].dataType, T.ArrayType):
        joined = F.coalesce(F.array_join("labels", ", "), F.lit("None"))
    else:
        joined = F.coalesce(F.col("labels").cast("string"), F.lit("None"))
    return df.drop("_id").withColumns({**dates, "labels_str": joined})


def read_embeddings(spark: SparkSession, root: str) -> DataFrame:
    """Vectors (row_id, embedding) of the model tag that the latest pointer names."""
    pointer = spark.read.json(f"{root}/latest").first()
    if pointer is None:
        raise ValueError(f"no latest embedding pointer in {root}")
    df = spark.read.parquet(f"{root}/vectors").where(F.col("model_tag") == pointer["model_tag"])
    return df.select("row_id", "embedding")


def read_stream(
    spark: SparkSession, path: str, max_files: int = 1, schema: T.StructType | None = None
) -> DataFrame:
    """File stream of messages (key, value, timestamp, partition, offset) landed as JSON lines."""
    use_utc(spark)
    message = schema or T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return spark.readStream.schema(message).option("maxFilesPerTrigger", max_files).json(path)


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int = 1000) -> DataFrame:
    """Message-broker stream from the earliest offset; needs the broker's Spark connector."""
    use_utc(spark)
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .load()
    )
