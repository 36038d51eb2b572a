"""Cleaning, de-duplication and time rules on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from issuelab.functions import timing
from issuelab.operators import clean, features
from issuelab.plans.dataset import training_table
from issuelab.schemas import CLEAN_COLS

RAW = (
    "repo_full_name string, number string, title string, body string, labels array<string>, "
    "author_association string, comments string, num_assignees string, created_at string, "
    "updated_at string, closed_at string, first_comment_at string, is_pull_request boolean, ingest_seq long"
)


def raw(spark, rows):
    base = {
        "repo_full_name": "o/r", "number": "1", "title": "t", "body": "b", "labels": [],
        "author_association": None, "comments": "0", "num_assignees": "0",
        "created_at": "2024-01-01T00:00:00Z", "updated_at": None, "closed_at": None,
        "first_comment_at": None, "is_pull_request": False, "ingest_seq": 0,
    }
    names = [f.split()[0] for f in RAW.split(", ")]
    return spark.createDataFrame(
        [tuple({**base, "ingest_seq": i, **r}[n] for n in names) for i, r in enumerate(rows)], RAW
    )


def test_time_parsing_is_lenient(spark):
    rows = ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "", "soon", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r[0] for r in df.select(F.unix_timestamp(timing.parse_utc("s"))).collect()]
    assert got == [1704067200, 1704067200, None, None, None]


def test_tie_goes_to_the_row_without_update_time(spark):
    df = raw(spark, [
        {"created_at": "2024-01-05T00:00:00Z", "updated_at": None, "title": "undated"},
        {"created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-05T00:00:00Z", "title": "dated"},
    ])
    assert [r["title"] for r in clean.clean_and_dedup(df).collect()] == ["undated"]


def test_first_pass_matters_for_rows_without_update_time(spark):
    """Of two undated rows the later-ingested survives, even when created earlier."""
    df = raw(spark, [
        {"created_at": "2024-01-09T00:00:00Z", "title": "first"},
        {"created_at": "2024-01-02T00:00:00Z", "title": "second"},
        {"created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-05T00:00:00Z", "title": "dated"},
    ])
    assert [r["title"] for r in clean.clean_and_dedup(df).collect()] == ["dated"]


def two_pass(rows):
    """Brute-force form of the two de-duplication passes."""
    firsts = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        firsts[(r["k"], r["u"])] = r
    best = {}
    for r in firsts.values():
        key = (r["u"] if r["u"] is not None else r["c"], r["u"] is None, r["seq"])
        if r["k"] not in best or key > best[r["k"]][0]:
            best[r["k"]] = (key, r["seq"])
    return sorted(seq for _, seq in best.values())


def test_one_aggregation_equals_two_passes(spark):
    rng = random.Random(3)
    rows = [
        {"k": rng.randrange(60), "c": rng.randrange(6), "u": rng.choice([None, 0, 1, 2, 3, 4, 5]), "seq": i}
        for i in range(800)
    ]
    at = lambda v: None if v is None else f"2024-01-0{v + 1}T00:00:00Z"
    df = raw(spark, [
        {"number": str(r["k"]), "created_at": at(r["c"]), "updated_at": at(r["u"]), "ingest_seq": r["seq"]}
        for r in rows
    ])
    got = sorted(r["ingest_seq"] for r in clean.clean_and_dedup(df).collect())
    assert got == two_pass(rows)


def test_coercion_labels_and_sanity(spark):
    df = raw(spark, [
        {"number": "7", "comments": "3.9", "num_assignees": "many", "labels": ["a", None],
         "closed_at": "2023-12-31T00:00:00Z", "first_comment_at": "2024-01-01T00:00:00Z"},
        {"number": "x"}, {"created_at": "bad"}, {"number": "8", "is_pull_request": True},
        {"number": "9", "labels": None, "comments": "NaN"},
    ])
    got = {r["number"]: r for r in clean.clean_and_dedup(df).collect()}
    assert set(got) == {7, 9}
    assert (got[7]["comments"], got[7]["num_assignees"], got[7]["labels"]) == (3, 0, ["a"])
    assert got[7]["closed_ts"] is None and got[7]["first_comment_ts"] is not None
    assert got[9]["labels"] == [] and got[9]["comments"] == 0


def test_missing_columns_and_null_flag(spark):
    df = spark.createDataFrame(
        [("o/r", 1, "2024-01-01T00:00:00Z", 0)], "repo_full_name string, number long, created_at string, ingest_seq long"
    )
    out = training_table(df)
    assert out.columns == CLEAN_COLS
    row = out.first()
    assert row["row_id"] == "o/r#1" and row["text"] == "" and row["labels_count"] == 0 and row["is_closed"] == 0


def test_text_and_calendar_features(spark):
    df = raw(spark, [{
        "title": "\n 　Crash", "body": "on start \U0001f600\n", "created_at": "2024-01-01T23:30:00Z",
        "labels": ["Kind/BUG", "docker"], "closed_at": "2024-01-31T23:30:00Z",
        "first_comment_at": "2024-01-02T01:00:00Z",
    }])
    r = training_table(df).first()
    assert r["text"] == "Crash on start \U0001f600"
    assert (r["created_dow"], r["created_hour"], r["ttf_hours"]) == (0, 23, 1.5)
    assert (r["days_to_close"], r["resolved_30d"], r["body_len"]) == (30.0, 1, 11)


def test_cap_keeps_open_issues(spark):
    df = raw(spark, [
        {"number": "1"}, {"number": "2", "closed_at": "2024-01-03T00:00:00Z"},
        {"number": "3", "closed_at": "2024-06-03T00:00:00Z"},
    ])
    ids = lambda cap: sorted(r["number"] for r in training_table(df, cap).collect())
    assert ids(0) == [1, 2, 3] and ids(30) == [1, 2]


def test_label_flags_by_substring(spark):
    df = spark.createDataFrame([("Debug docker CVE-1",), ("help wanted",), ("",)], "labels_str string")
    flags = features.keyword_flags()
    got = [tuple(r) for r in df.select(*[flags[k] for k in ("has_bug", "has_docs", "has_security", "has_question", "has_help_wanted")]).collect()]
    assert got == [(1, 1, 1, 0, 0), (0, 0, 0, 1, 1), (0, 0, 0, 0, 0)]


def test_author_flags_differ_between_training_and_serving(spark):
    df = spark.createDataFrame([(None,), ("owner",), ("COLLABORATOR",), ("NONE",)], "author_association string")
    pick = lambda serving: [
        [k for k, v in r.asDict().items() if v] for r in df.select(*[e.alias(n) for n, e in features.author_flags(serving).items()]).collect()
    ]
    assert pick(False) == [["author_is_none"], ["author_is_owner"], ["author_is_other"], ["author_is_none"]]
    assert pick(True)[0] == ["author_is_other"]


def test_leak_guard():
    with pytest.raises(ValueError, match="closed_ts"):
        features.check_no_leak(["comments", "closed_ts"])


def test_serving_imputation(spark):
    df = spark.createDataFrame([(0, 2), (None, 0), (5, 1)], "comments int, num_assignees int")
    assert [tuple(r) for r in features.with_activity(df).collect()] == [(1, 2), (None, 1), (5, 1)]


def test_narrow_build_equals_the_full_table(spark):
    df = raw(spark, [
        {"number": str(i % 7), "title": f"t{i}", "body": "x" * i, "labels": ["a", None], "comments": str(i),
         "updated_at": f"2024-01-0{i % 9 + 1}T00:00:00Z", "closed_at": f"2024-02-0{i % 5 + 1}T00:00:00Z",
         "first_comment_at": f"2024-01-01T0{i % 9}:00:00Z"}
        for i in range(40)
    ])
    columns = [c for c in CLEAN_COLS if c not in ("title", "body")]
    full = sorted(map(str, training_table(df, 33.0).select(*columns).collect()))
    assert sorted(map(str, training_table(df, 33.0, columns=columns).collect())) == full
    few = ["row_id", "body_len", "days_to_close"]
    want = sorted(map(str, training_table(df).select(*few).collect()))
    assert sorted(map(str, training_table(df, columns=few).collect())) == want
