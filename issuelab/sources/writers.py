"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.functions.text import file_safe_repo, model_tag
from issuelab.functions.timing import iso_zone
from issuelab.sources import export

TS_COLS = ["created_ts", "updated_ts", "closed_ts", "first_comment_ts"]


def write_training(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def iso_export(df: DataFrame) -> DataFrame:
    """The four timestamps as ISO text with a zone; null stays null."""
    return df.withColumns({c: iso_zone(c) for c in TS_COLS})


def write_jsonl(df: DataFrame, path: str) -> None:
    iso_export(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def dataset_meta(df: DataFrame, **facts: str | float) -> DataFrame:
    """One row: row count, column list and the given facts about the run."""
    return df.agg(F.count("*").alias("n_rows")).withColumns(
        {
            **{k: F.lit(v) for k, v in facts.items()},
            "columns": F.array(*[F.lit(c) for c in df.columns]),
        }
    )


def write_meta(df: DataFrame, path: str, **facts: str | float) -> None:
    dataset_meta(df, **facts).write.mode("overwrite").json(path)


def append_by_repo(df: DataFrame, path: str, run_ts: str) -> None:
    """JSON lines per repository and run.

    Rebalancing keeps small repositories in one file each and splits a large one over several tasks.
    """
    (
        df.withColumns(
            {"repo_key": file_safe_repo("repo_full_name"), "run_ts": F.lit(run_ts)}
        )
        .hint("rebalance", "repo_key")
        .write.mode("append")
        .partitionBy("repo_key", "run_ts")
        .option("ignoreNullFields", False)
        .json(path)
    )


def message_key() -> Column:
    return F.col("id").cast("string")


def message_value(df: DataFrame) -> Column:
    """All columns as one JSON object; a missing value is written as null."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def message_payload(df: DataFrame) -> DataFrame:
    """Key and JSON value of each issue as published."""
    return df.select(message_key().alias("key"), message_value(df).alias("value"))


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Write messages to the broker; needs the broker's Spark connector."""
    (
        message_payload(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def write_embeddings(df: DataFrame, root: str, model_name: str) -> None:
    """Vectors per model tag, and the pointer to the tag written last."""
    spark = df.sparkSession
    tag: Column = model_tag(F.lit(model_name))
    (
        df.select("row_id", "embedding", tag.alias("model_tag"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_tag")
        .parquet(f"{root}/vectors")
    )
    meta = spark.range(1).select(
        tag.alias("model_tag"), F.lit(model_name).alias("model_name"), F.lit("float").alias("dtype")
    )
    meta.write.mode("overwrite").json(f"{root}/latest")


def write_state(df: DataFrame, root: str, version: int) -> str:
    """New version of the run state, written beside the old one."""
    path = f"{root}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_export(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as documents of a document-store export, a file per task; the first column comes first in all."""
    export.register(df.sparkSession)
    df.write.format(export.FORMAT).mode(mode).save(path)
