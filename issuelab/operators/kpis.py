"""Activity and data-quality questions on the issue table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.functions.labels import any_matches, joined_contains
from issuelab.functions.timing import exact_days, month_of
from issuelab.operators.features import HORIZON_DAYS, within
from issuelab.operators.ordering import exact_median


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, by: str, k: int) -> DataFrame:
    """Largest groups; equal counts are ordered by key."""
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(by)).limit(k)


def counts_by(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"))


def flag_count(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count_if(F.col(flag)).alias("n"))


def keyword_classes(df: DataFrame) -> DataFrame:
    """Issues with a bug-like and with a feature-like label element."""
    return df.agg(
        F.count_if(any_matches("bug")).alias("bugs"),
        F.count_if(any_matches("enhancement|feature")).alias("features"),
    )


def bug_share(df: DataFrame) -> DataFrame:
    """Issues whose joined labels mention a bug, and their percentage (0 for no issues)."""
    hit = joined_contains("bug")
    return df.agg(
        F.count_if(hit).alias("bugs"),
        F.coalesce(F.avg(hit.cast("double")) * 100, F.lit(0.0)).alias("bug_pct"),
    )


def new_today(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    day = F.current_date() if as_of is None else F.to_date(as_of)
    return df.agg(F.count_if(F.to_date("created_at") == day).alias("n"))


def velocity(df: DataFrame) -> DataFrame:
    """Mean days from opening to closing over closed issues."""
    return df.where(F.col("closed_at").isNotNull()).agg(
        F.avg(exact_days("created_at", "closed_at")).alias("avg_days"), F.count("*").alias("closed")
    )


def open_ratio(df: DataFrame) -> DataFrame:
    is_open = F.coalesce(F.col("state") == "open", F.lit(False))
    return df.agg(
        F.count_if(is_open).alias("open"),
        F.coalesce(F.avg(is_open.cast("double")) * 100, F.lit(0.0)).alias("open_pct"),
    )


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def audit_columns(df: DataFrame) -> DataFrame:
    """Days to close (computed if absent, never negative), 30-day outcome and creation month."""
    df = lower_names(df)
    days = F.col("days_to_close") if "days_to_close" in df.columns else exact_days("created_at", "closed_at")
    df = df.withColumn("days_to_close", F.when(days.isNotNull(), F.greatest(days, F.lit(0.0))))
    return df.withColumns(
        {
            "resolved_30d": within("days_to_close", HORIZON_DAYS),
            "created_month": month_of("created_at"),
        }
    )


def audit_kpis(df: DataFrame) -> DataFrame:
    """Row count, mean and exact median days to close, share closed within 30 days of all rows."""
    main = df.agg(
        F.count("*").alias("n"),
        F.avg("days_to_close").alias("mean_days"),
        (F.avg("resolved_30d") * 100).alias("sla_30d_pct"),
    )
    return main.crossJoin(  # one row each
        exact_median(df, "days_to_close").select(F.col("median").alias("median_days"))
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are listed with 0."""
    v = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_of = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
    counted = (
        v.crossJoin(F.broadcast(span))  # one row
        .groupBy(F.coalesce(bin_of, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", width.alias("w")
    )
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("w")).alias("lower"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def daily_counts(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Issues per day from the first to the last day, quiet days as 0."""
    days = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    calendar = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(
        F.explode(F.sequence("a", "b", F.make_dt_interval(F.lit(1)))).alias("day")
    )
    return calendar.join(days, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def recent_open(df: DataFrame, k: int = 20) -> DataFrame:
    """Newest open issues; equal times are ordered by id."""
    return df.where("state = 'open'").orderBy(F.desc("created_at"), F.asc("id")).limit(k)


def scored_view(df: DataFrame, score: str) -> DataFrame:
    return df.select("number", "title", score, "created_at")


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    return df.limit(n)


def describe_table(df: DataFrame) -> DataFrame:
    """Row count and the ordered column list."""
    return df.agg(
        F.count("*").alias("n_rows"), F.array(*[F.lit(c) for c in df.columns]).alias("columns")
    )
