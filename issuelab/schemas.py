"""Declared schemas and the fixed value lists the results depend on."""

from pyspark.sql import types as T

_STR, _LONG, _INT, _BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_STRS = T.ArrayType(_STR)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# One flat issue record, as collected or as carried by a stream message.
ISSUE_RAW = _struct(
    ("collected_at", _STR),
    ("repo_full_name", _STR),
    ("id", _LONG),
    ("node_id", _STR),
    ("number", _INT),
    ("state", _STR),
    ("state_reason", _STR),
    ("title", _STR),
    ("body", _STR),
    ("user_login", _STR),
    ("author_association", _STR),
    ("labels", _STRS),
    ("comments", _INT),
    ("created_at", _STR),
    ("updated_at", _STR),
    ("closed_at", _STR),
    ("assignees", _STRS),
    ("num_assignees", _INT),
    ("locked", _BOOL),
    ("active_lock_reason", _STR),
    ("milestone", _STR),
    ("html_url", _STR),
    ("url", _STR),
    ("is_pull_request", _BOOL),
    ("first_comment_at", _STR),
)

# The nested issue object of the hosting API.
ISSUE_API = _struct(
    ("id", _LONG),
    ("node_id", _STR),
    ("number", _INT),
    ("state", _STR),
    ("state_reason", _STR),
    ("title", _STR),
    ("body", _STR),
    ("user", _struct(("login", _STR))),
    ("author_association", _STR),
    ("labels", T.ArrayType(_STR)),  # plain names, or objects, which are read as their JSON text
    ("comments", _INT),
    ("created_at", _STR),
    ("updated_at", _STR),
    ("closed_at", _STR),
    ("assignees", T.ArrayType(_struct(("login", _STR)))),
    ("locked", _BOOL),
    ("active_lock_reason", _STR),
    ("milestone", _struct(("title", _STR))),
    ("html_url", _STR),
    ("url", _STR),
    ("pull_request", T.MapType(_STR, _STR)),
)

# The nested repository object of the hosting API.
REPO_API = _struct(
    ("id", _LONG),
    ("node_id", _STR),
    ("full_name", _STR),
    ("name", _STR),
    ("owner", _struct(("login", _STR))),
    ("html_url", _STR),
    ("description", _STR),
    ("created_at", _STR),
    ("updated_at", _STR),
    ("pushed_at", _STR),
    ("language", _STR),
    ("topics", _STRS),
    ("stargazers_count", _LONG),
    ("forks_count", _LONG),
    ("watchers_count", _LONG),
    ("open_issues_count", _LONG),
    ("archived", _BOOL),
    ("disabled", _BOOL),
    ("has_issues", _BOOL),
    ("size", _LONG),
    ("license", _struct(("spdx_id", _STR))),
    ("default_branch", _STR),
    ("visibility", _STR),
)

# A scoring request; missing text is empty, missing counts are 0, missing flag is false.
SCORE_REQUEST = _struct(
    ("repo_full_name", _STR),
    ("number", _LONG),
    ("title", _STR),
    ("body", _STR),
    ("labels", _STRS),
    ("author_association", _STR),
    ("comments", _INT),
    ("num_assignees", _INT),
    ("created_at", _STR),
    ("updated_at", _STR),
    ("closed_at", _STR),
    ("first_comment_at", _STR),
    ("is_pull_request", _BOOL),
)

# The columns a raw issue table must offer.
REQUIRED_COLS = [
    "repo_full_name", "number", "title", "body", "labels", "author_association", "comments",
    "num_assignees", "created_at", "updated_at", "closed_at", "first_comment_at", "is_pull_request",
]

# The training table, in order.
CLEAN_COLS = [
    "row_id", "repo_full_name", "number", "title", "body", "labels", "author_association",
    "comments", "num_assignees", "created_at", "updated_at", "closed_at", "first_comment_at",
    "created_ts", "updated_ts", "closed_ts", "first_comment_ts", "text", "labels_str",
    "labels_count", "title_len", "body_len", "has_body", "created_dow", "created_hour",
    "ttf_hours", "is_closed", "days_to_close", "resolved_30d",
]

# Tabular model inputs.
BASE_FEATURES = [
    "comments", "num_assignees", "labels_count", "title_len", "body_len", "has_body",
    "created_dow", "created_hour",
]
TTF_FEATURES = ["ttf_missing", "ttf_capped_72h", "ttf_log1p"]

# Label flag -> substrings of the lower-cased joined labels.
LABEL_KEYWORDS = {
    "has_bug": ["bug"],
    "has_docs": ["doc", "documentation"],
    "has_feature": ["feature", "enhancement"],
    "has_question": ["question", "help wanted"],
    "has_security": ["security", "vulnerability", "cve"],
    "has_good_first_issue": ["good first issue"],
    "has_help_wanted": ["help wanted"],
}

# Author associations with a flag of their own.
AUTHOR_FLAGS = {
    "author_is_owner": "OWNER",
    "author_is_member": "MEMBER",
    "author_is_contributor": "CONTRIBUTOR",
    "author_is_none": "NONE",
}

# Columns that would reveal the answer.
FORBIDDEN_FEATURES = {
    "days_to_close", "resolved_30d", "is_closed", "close_within_h", "close_within_H", "closed_at",
    "closed_ts", "updated_at", "updated_ts", "first_comment_at", "first_comment_ts", "dedup_ts",
}


def feature_order(repo_prior: str) -> list[str]:
    """The 26 tabular features; ``repo_prior`` is the stage's own history column."""
    return [
        *BASE_FEATURES,
        *TTF_FEATURES,
        "body_missing",
        *LABEL_KEYWORDS,
        *AUTHOR_FLAGS,
        "author_is_other",
        "repo_count_train",
        repo_prior,
    ]


STAGE1_FEATURES = feature_order("repo_posrate_train")
STAGE2_FEATURES = feature_order("repo_median_days_train")

# The older nine-column model input.
LEGACY_FEATURES = [*BASE_FEATURES, "ttf_hours"]
