"""Derived text, label, time and target columns, and the model's tabular inputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.functions.labels import keyword_flags
from issuelab.functions.text import full_text
from issuelab.functions.timing import exact_days, exact_hours, parse_utc
from issuelab.operators.lookup import lookup_join
from issuelab.schemas import (
    AUTHOR_FLAGS,
    BASE_FEATURES,
    FORBIDDEN_FEATURES,
    LEGACY_FEATURES,
    feature_order,
)

HORIZON_DAYS = 30.0


def within(days: str, horizon: float) -> Column:
    """1 if closed within the horizon, else 0; an open issue counts as 0."""
    return F.coalesce((F.col(days) <= horizon).cast("int"), F.lit(0))


def nonnegative_hours(start: str, end: str) -> Column:
    hours = exact_hours(start, end)
    return F.when(hours >= 0, hours)


def with_text(df: DataFrame) -> DataFrame:
    """Title and body without nulls, and what is derived from them alone."""
    title, body = F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))
    return df.withColumns(
        {
            "title": title,
            "body": body,
            "text": full_text(),
            "title_len": F.char_length(title),
            "body_len": F.char_length(body),
            "has_body": (F.char_length(body) > 0).cast("int"),
        }
    )


def derived_columns() -> dict[str, tuple[list[str], Column]]:
    """Other derived columns: inputs they need, and their expression."""
    days = exact_days("created_ts", "closed_ts")
    return {
        "labels_str": (["labels"], F.array_join("labels", " ")),
        "labels_count": (["labels"], F.size("labels")),
        "created_dow": (["created_ts"], F.weekday("created_ts")),
        "created_hour": (["created_ts"], F.hour("created_ts")),
        "ttf_hours": (["first_comment_ts"], nonnegative_hours("created_ts", "first_comment_ts")),
        "days_to_close": (["closed_ts"], days),
        "is_closed": (["closed_ts"], F.col("closed_ts").isNotNull().cast("int")),
        "resolved_30d": (["closed_ts"], F.coalesce((days <= HORIZON_DAYS).cast("int"), F.lit(0))),
    }


def add_features_and_targets(df: DataFrame) -> DataFrame:
    """Text, label, length, time and target columns of the training table."""
    return with_text(df).withColumns({name: expr for name, (_, expr) in derived_columns().items()})


def ttf_features(hours: Column, fill: float) -> dict[str, Column]:
    filled = F.coalesce(hours, F.lit(float(fill)))
    return {
        "ttf_missing": hours.isNull().cast("double"),
        "ttf_capped_72h": F.least(filled, F.lit(72.0)),
        "ttf_log1p": F.log1p(F.greatest(filled, F.lit(0.0))),
    }


def author_flags(serving: bool = False) -> dict[str, Column]:
    """One flag per association. A missing author reads NONE in training and OTHER at serving."""
    author = F.col("author_association")
    if serving:
        author = F.nullif(author, F.lit(""))
    name = F.upper(F.coalesce(author, F.lit("OTHER" if serving else "NONE")))
    flags = {flag: (name == value).cast("double") for flag, value in AUTHOR_FLAGS.items()}
    return {**flags, "author_is_other": (~name.isin(list(AUTHOR_FLAGS.values()))).cast("double")}


@dataclass(frozen=True)
class RepoPriors:
    """History per repository: a keyed table and the fallbacks for an unseen repository."""

    table: DataFrame  # repo_full_name, cnt, <value>; read from a written table
    value: str  # posrate | median_days
    global_count: float
    global_value: float

    @property
    def feature(self) -> str:
        return f"repo_{self.value}_train"


def join_priors(df: DataFrame, priors: RepoPriors) -> DataFrame:
    """Add the two history features; an unseen repository gets the global values."""
    table = priors.table.select(
        "repo_full_name", F.col("cnt").alias("_cnt"), F.col(priors.value).alias("_value")
    )
    spread = [c for c in ("row_id", "number", "id") if c in df.columns]
    joined = lookup_join(df, table, "repo_full_name", weight="_cnt", spread_by=spread, staged=True)
    return joined.withColumns(history_features("_cnt", "_value", priors)).drop("_cnt", "_value")


def history_features(count: str, value: str, priors: RepoPriors) -> dict[str, Column]:
    """The two history features of a row with its repository's numbers, null for an unseen one."""
    known = F.coalesce(F.col(count).cast("double"), F.lit(float(priors.global_count)))
    return {
        "repo_count_train": F.log1p(F.greatest(known, F.lit(0.0))),
        priors.feature: F.coalesce(value, F.lit(float(priors.global_value))),
    }


def join_all_histories(df: DataFrame, fitted: Mapping[int, RepoPriors]) -> DataFrame:
    """Add each fit's numbers of a row's repository as ``_cnt_<fit>`` and ``_value_<fit>``, in one look-up join."""
    parts = [
        p.table.select("repo_full_name", F.lit(fit).alias("_fit"), F.col("cnt").alias("_n"), F.col(p.value).alias("_v"))
        for fit, p in fitted.items()
    ]
    own = lambda fit, c: F.max(F.when(F.col("_fit") == fit, F.col(c)))
    numbers = {f"_cnt_{fit}": own(fit, "_n") for fit in fitted} | {f"_value_{fit}": own(fit, "_v") for fit in fitted}
    table = reduce(DataFrame.unionByName, parts).groupBy("repo_full_name").agg(
        F.sum("_n").alias("_weight"), *[column.alias(name) for name, column in numbers.items()]
    )
    spread = [c for c in ("row_id", "number", "id") if c in df.columns]
    return lookup_join(df, table, "repo_full_name", weight="_weight", spread_by=spread).drop("_weight")


def at_creation(df: DataFrame) -> DataFrame:
    """What is known when an issue is opened: no comments, no first answer."""
    return df.withColumns(
        {"comments": F.lit(0).cast("long"), "ttf_hours": F.lit(None).cast("double")}
    )


def check_no_leak(columns: list[str]) -> None:
    leaked = sorted(set(columns) & FORBIDDEN_FEATURES)
    if leaked:
        raise ValueError(f"forbidden columns among the features: {leaked}")


def tabular_features(
    df: DataFrame,
    priors: RepoPriors,
    ttf_fill: float,
    moment: str = "latest",
    serving: bool = False,
    keep: tuple[str, ...] = ("row_id",),
) -> DataFrame:
    """``keep`` columns and the 26 features as doubles, in the fixed order."""
    order = feature_order(priors.feature)
    check_no_leak(order)
    narrow = fixed_features(df, moment, serving, keep).withColumns(ttf_features(F.col("ttf_hours"), ttf_fill))
    joined = join_priors(narrow, priors)
    return joined.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep], *[F.col(c).cast("double") for c in order]
    )


def fixed_features(
    df: DataFrame, moment: str = "latest", serving: bool = False, keep: tuple[str, ...] = ("row_id",)
) -> DataFrame:
    """``keep`` columns as ``_keep_<name>``, the features that are not fitted, and what the fitted ones hang on."""
    if moment not in ("latest", "t0"):
        raise ValueError("moment must be 'latest' or 't0'")
    if moment == "t0":
        df = at_creation(df)
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    body_missing = F.col("body").isNull() if "body" in df.columns else F.lit(False)
    base = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in BASE_FEATURES}
    return df.select(
        *kept,
        "repo_full_name",
        "ttf_hours",
        *[expr.alias(name) for name, expr in base.items()],
        body_missing.cast("double").alias("body_missing"),
        *[expr.alias(name) for name, expr in keyword_flags().items()],
        *[expr.alias(name) for name, expr in author_flags(serving).items()],
    )


def serving_rows(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Columns of one scoring request per row; a missing creation time is "now".

    Rows of a cleaned table may bring ``title_len`` and ``body_len`` in place of their texts.
    """
    now = F.current_timestamp() if as_of is None else as_of
    created = F.coalesce(parse_utc("created_at"), now)
    answered = parse_utc("first_comment_at")
    hours = exact_hours(created, answered)
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    size = lambda c: F.char_length(F.coalesce(c, F.lit(""))) if c in df.columns else F.col(f"{c}_len")
    text = {"text": full_text()} if {"title", "body"} <= set(df.columns) else {}
    return df.withColumns(
        {
            "comments": F.coalesce(F.col("comments").try_cast("long"), F.lit(0)),
            "num_assignees": F.coalesce(F.col("num_assignees").try_cast("long"), F.lit(0)),
            **text,
            "labels_str": F.array_join(labels, " "),
            "labels_count": F.size(labels),
            "title_len": size("title"),
            "body_len": size("body"),
            "has_body": (size("body") > 0).cast("int"),
            "created_dow": F.weekday(created),
            "created_hour": F.hour(created),
            "ttf_hours": F.when(hours >= 0, hours),
        }
    )


def with_activity(df: DataFrame) -> DataFrame:
    """Serving-time imputation: zero comments or assignees count as one; null is left to cleaning.

    Neutral dates play no part: the cleaning step derives every time column from the raw text.
    """
    one = lambda c: F.when(F.col(c) == 0, 1).otherwise(F.col(c)) if c in df.columns else F.lit(1)
    return df.withColumns({c: one(c) for c in ("comments", "num_assignees")})


def legacy_features(df: DataFrame) -> DataFrame:
    """The older nine inputs, null or absent as 0."""
    zero = F.lit(0.0)
    return df.select(
        "row_id",
        *[
            (F.coalesce(F.col(c).cast("double"), zero) if c in df.columns else zero).alias(c)
            for c in LEGACY_FEATURES
        ],
    )
