"""Streaming jobs: parse, enrich, upsert; and emit-once publishing."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from issuelab.operators.enrich import clean_and_enrich, parse_messages
from issuelab.streaming.store import handed_over, record_handover, write_batch

log = logging.getLogger(__name__)


def enriched(messages: DataFrame, **options) -> DataFrame:
    """Parsed and enriched issues; ``messages`` may be a table or a stream."""
    return clean_and_enrich(parse_messages(messages), **options)


def _upsert(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path)  # an error stops the query; the batch is retried
        written = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/log/batch_id={batch_id}")
        sample = F.first(F.struct("repo_full_name", "number", "state", "label_count"))
        seen = written.agg(F.count("*").alias("n"), sample.alias("sample")).first()
        log.info("batch %d: %d issues, e.g. %s", batch_id, seen["n"], seen["sample"])

    return write


def start_upsert(
    issues: DataFrame, path: str, checkpoint: str, interval: str | None = "30 seconds"
) -> StreamingQuery:
    """Upsert a stream of enriched issues; ``interval=None`` works off what is there and stops."""
    writer = (
        issues.writeStream.foreachBatch(_upsert(path))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def emit_once(stream: DataFrame, within: str | None = None, event_time: str = "event_ts") -> DataFrame:
    """First message per id over the whole run.

    Exact by default; the ids seen live in the state store and survive restarts. ``within`` bounds
    the state: a repeat later than that may be emitted again.
    """
    if within is None:
        return stream.dropDuplicates(["id"])
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["id"])


def start_log(df: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def backfill_then_live(history: DataFrame, live: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Load the history as batch 0 of the store, then follow the live stream.

    Live batches are numbered from 1 on, so the two never share a batch folder.
    """
    write_batch(history, 0, path)
    upsert = _upsert(path)
    writer = (
        live.writeStream.foreachBatch(lambda batch, batch_id: upsert(batch, batch_id + 1))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    interval = kw.get("interval")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def resume_backfill(
    history: DataFrame, live: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Work off the history stream, then follow the live stream; started again, it goes on where it was.

    The history has its own checkpoint, so none of its batches is written twice after a stop. Once it is through, the
    number of its batches is recorded beside the store (the hand-over); live batches are numbered from there.
    """
    spark = history.sparkSession
    count = handed_over(spark, path)
    if count is None:
        upsert = _upsert(path)
        writer = history.writeStream.foreachBatch(upsert).outputMode("append").trigger(availableNow=True)
        writer.option("checkpointLocation", f"{checkpoint}/history").start().awaitTermination()
        count = record_handover(spark, path)
    upsert = _upsert(path)
    writer = live.writeStream.foreachBatch(lambda batch, batch_id: upsert(batch, batch_id + count))
    writer = writer.outputMode("append").option("checkpointLocation", f"{checkpoint}/live")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
