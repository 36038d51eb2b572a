"""Message parsing and enrichment; the same functions serve a table and a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.functions.labels import has_exact
from issuelab.functions.timing import parse_utc, whole_hours
from issuelab.schemas import ISSUE_RAW

_DATES = ["collected_at", "created_at", "updated_at", "closed_at", "first_comment_at"]


def parse_messages(df: DataFrame) -> DataFrame:
    """Message key, time, partition, offset and the flat issue fields of the JSON value.

    Text that is no JSON gives nulls; one wrongly typed field is null without harming the others.
    """
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        # A generator keeps later filters from parsing the text once more per field.
        F.inline(F.array(F.from_json(F.col("value").cast("string"), ISSUE_RAW))),
    )


def with_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["id", "repo_full_name", "number"])


def label_count(null_as_minus_one: bool = False) -> Column:
    """Array size; ``null_as_minus_one`` gives the pre-ANSI answer for a missing array."""
    return F.coalesce(F.size("labels"), F.lit(-1)) if null_as_minus_one else F.size("labels")


def clean_and_enrich(
    df: DataFrame, as_of: Column | None = None, null_labels_as_minus_one: bool = False
) -> DataFrame:
    """Required keys, typed dates and the fifteen derived columns, in one projection."""
    now = F.current_timestamp() if as_of is None else as_of
    dates = {c: parse_utc(c) for c in _DATES}
    created, closed, answered = (dates[c] for c in ("created_at", "closed_at", "first_comment_at"))
    count = label_count(null_labels_as_minus_one)
    return with_keys(df).withColumns(
        {
            **dates,
            "processed_at": now,
            "label_count": count,
            "has_labels": count > 0,
            "has_assignees": F.col("num_assignees") > 0,
            "has_body": F.coalesce(F.char_length("body") > 0, F.lit(False)),
            "body_length": F.coalesce(F.char_length("body"), F.lit(0)),
            "title_length": F.coalesce(F.char_length("title"), F.lit(0)),
            "is_closed": F.col("state") == "closed",
            "is_bug": has_exact("bug"),
            "is_enhancement": has_exact("enhancement"),
            "is_documentation": has_exact("documentation"),
            "is_question": has_exact("question"),
            "time_to_close_hours": whole_hours(created, closed),
            "time_to_first_comment_hours": whole_hours(created, answered),
            "age_hours": whole_hours(created, now),
        }
    )
