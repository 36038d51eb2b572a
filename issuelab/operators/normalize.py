"""Nested API objects to flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.schemas import ISSUE_API, ISSUE_RAW, REPO_API


def _label_names(df: DataFrame, keep_null: bool) -> Column:
    """Names of labels given as objects, as JSON texts of objects, or as plain strings, also mixed.

    The form that keeps null names takes names from objects only.
    """
    kind = df.schema["labels"].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType)):
        return _named("labels", "name", keep_null)
    is_object = lambda x: F.ltrim(x).startswith("{")
    name = lambda x: F.when(is_object(x), F.get_json_object(x, "$.name")).otherwise(x)
    given = F.filter("labels", lambda x: x.isNotNull())
    if keep_null:
        given = F.filter(given, is_object)
    else:
        given = F.filter(given, lambda x: ~is_object(x) | (F.coalesce(name(x), F.lit("")) != ""))
    return F.coalesce(F.transform(given, name), F.array().cast("array<string>"))


def _named(array: str, field: str, keep_null: bool) -> Column:
    """Names inside an array of objects; null objects go, null or empty names go unless kept."""
    objects = F.filter(array, lambda o: o.isNotNull())
    names = F.transform(objects, lambda o: o[field])
    if not keep_null:
        names = F.filter(names, lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(names, F.array().cast("array<string>"))


def _complete(df: DataFrame, schema) -> DataFrame:
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize_issues(df: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Collector form: the 25 flat fields. The repository name comes with the row."""
    df = _complete(df, ISSUE_API)
    computed = {
        "collected_at": collected_at if collected_at is not None else F.current_timestamp().cast("string"),
        "user_login": F.col("user.login"),
        "labels": _label_names(df, keep_null=False),
        "assignees": _named("assignees", "login", keep_null=False),
        "num_assignees": F.coalesce(
            F.size(F.filter("assignees", lambda a: a.isNotNull())), F.lit(0)
        ),
        "milestone": F.col("milestone.title"),
        # An empty object counts as "not a pull request".
        "is_pull_request": F.coalesce(F.size("pull_request") > 0, F.lit(False)),
        "first_comment_at": F.lit(None).cast("string"),
    }
    return df.select(
        *[computed[f.name].alias(f.name) if f.name in computed else F.col(f.name) for f in ISSUE_RAW]
    )


def normalize_live_issues(df: DataFrame) -> DataFrame:
    """Producer form: the API object with four fields flattened; null names are kept."""
    df = _complete(df, ISSUE_API)
    return df.withColumns(
        {
            "user_login": F.col("user.login"),
            "labels": _label_names(df, keep_null=True),
            "assignees": _named("assignees", "login", keep_null=True),
        }
    )


def normalize_repos(df: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """Repository record: owner and license flattened, missing topics empty; extra columns stay."""
    extra = [c for c in df.columns if c not in REPO_API.fieldNames()]
    df = _complete(df, REPO_API)
    computed = {
        "owner": F.col("owner.login").alias("owner_login"),
        "license": F.col("license.spdx_id").alias("license"),
        "topics": F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
    }
    stamp = collected_at if collected_at is not None else F.current_timestamp().cast("string")
    return df.select(
        stamp.alias("collected_at"),
        *[computed.get(f.name, F.col(f.name)) for f in REPO_API],
        *extra,
    )
