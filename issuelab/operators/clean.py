"""Raw records to one current row per issue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.functions.labels import without_nulls
from issuelab.functions.timing import parse_utc
from issuelab.schemas import CLEAN_COLS, REQUIRED_COLS

_ARRAYS = {"labels"}
_ISSUE = ["repo_full_name", "number"]


def ensure_required(df: DataFrame) -> DataFrame:
    """Add absent required columns as null; a missing pull-request flag means "no"."""
    blank = {
        c: F.lit(None).cast("array<string>" if c in _ARRAYS else "string")
        for c in REQUIRED_COLS
        if c not in df.columns
    }
    df = df.withColumns(blank) if blank else df
    flag = F.coalesce(F.col("is_pull_request").try_cast("boolean"), F.lit(False))
    return df.withColumn("is_pull_request", flag)


def drop_pull_requests(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_pull_request"))


def lenient_long(df: DataFrame, name: str) -> Column:
    """Whole number from a loosely typed column, truncated; bad input gives null."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("long")
    return F.col(name).try_cast("double").try_cast("long")


def typed(df: DataFrame) -> DataFrame:
    """Typed counts, label arrays without nulls and parsed timestamps."""
    return df.withColumns(
        {
            "labels": without_nulls(),
            "comments": F.coalesce(lenient_long(df, "comments"), F.lit(0)),
            "num_assignees": F.coalesce(lenient_long(df, "num_assignees"), F.lit(0)),
            "number": lenient_long(df, "number"),
            "created_ts": parse_utc("created_at"),
            "updated_ts": parse_utc("updated_at"),
            "closed_ts": parse_utc("closed_at"),
            "first_comment_ts": parse_utc("first_comment_at"),
        }
    )


def with_identity(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["created_ts", *_ISSUE])


def snapshot_dedup(df: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Last-ingested row per (issue, update time); a null update time is a group of its own.

    Spark prunes each map task to one row per group before the shuffle.
    """
    w = Window.partitionBy(*_ISSUE, "updated_ts").orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_state(df: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Current row per issue: snapshot de-duplication, then the latest update (or creation) time.

    Both passes fold into one aggregation. Among rows with an update time the latest one, last
    ingested, wins; among rows without, the last ingested; of these two the later effective time
    wins, and on a tie the row without an update time. Partial aggregation keeps two rows per issue
    and map task, so an issue collected a billion times does not gather anywhere.
    """
    row = F.struct(*df.columns)
    known = F.col("updated_ts").isNotNull()
    best = df.groupBy(*_ISSUE).agg(
        F.max_by(row, F.when(known, F.struct("updated_ts", order))).alias("dated"),
        F.max_by(row, F.when(~known, F.col(order))).alias("undated"),
    )
    prefer_undated = F.col("dated").isNull() | (
        F.col("undated.created_ts") >= F.col("dated.updated_ts")
    )
    winner = F.when(prefer_undated, F.col("undated")).otherwise(F.col("dated"))
    return best.select(F.inline(F.array(winner)))


def sane_times(df: DataFrame) -> DataFrame:
    """A close or first comment before creation is dropped; the row stays."""
    ends = [c for c in ("closed_ts", "first_comment_ts") if c in df.columns]
    return df.withColumns({c: F.when(F.col(c) >= F.col("created_ts"), F.col(c)) for c in ends})


def clean_and_dedup(df: DataFrame, order: str = "ingest_seq") -> DataFrame:
    rows = with_identity(typed(drop_pull_requests(ensure_required(df))))
    return sane_times(latest_state(rows, order))


def capped(df: DataFrame, cap_days: float = 0.0) -> DataFrame:
    """Keep open issues and those closed within the cap; 0 turns the cap off."""
    if not cap_days or cap_days <= 0:
        return df
    return df.where(F.col("days_to_close").isNull() | (F.col("days_to_close") <= cap_days))


def row_id() -> Column:
    return F.concat_ws("#", "repo_full_name", F.col("number").cast("string"))


def training_columns(df: DataFrame) -> DataFrame:
    """The fixed column list, absent columns as null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in CLEAN_COLS])
