"""Message parsing, enrichment, normalisation."""

import json

from pyspark.sql import functions as F

from issuelab.functions import labels, text
from issuelab.operators import decide, enrich, kpis, normalize
from issuelab.schemas import ISSUE_API, REPO_API


def messages(spark, values):
    rows = [(str(i), v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, offset long").withColumns(
        {"timestamp": F.current_timestamp(), "partition": F.lit(0)}
    )


def test_parse_malformed_and_wrongly_typed(spark):
    good = {"id": 1, "repo_full_name": "o/r", "number": 2, "state": "closed", "milestone": {"title": "v1"}}
    vals = [json.dumps(good), "{not json", json.dumps({**good, "number": "two"}), json.dumps({**good, "comments": "x", "id": 5})]
    got = enrich.parse_messages(messages(spark, vals)).orderBy("kafka_offset").collect()
    assert json.loads(got[0]["milestone"]) == {"title": "v1"}
    assert got[1]["id"] is None and got[1]["state"] is None
    assert got[2]["number"] is None and got[2]["id"] == 1
    assert got[3]["comments"] is None and got[3]["id"] == 5
    kept = enrich.with_keys(enrich.parse_messages(messages(spark, vals))).collect()
    assert sorted(r["id"] for r in kept) == [1, 5]


def test_enrichment_nulls(spark):
    base = {"id": 1, "repo_full_name": "o/r", "number": 2}
    vals = [
        json.dumps(base),
        json.dumps({**base, "id": 2, "labels": ["debug", "bug"], "body": "", "state": "open", "num_assignees": 0,
                    "created_at": "2024-01-02T00:00:00Z", "closed_at": "2024-01-01T00:00:00.9Z"}),
        json.dumps({**base, "id": 3, "labels": ["debug"], "body": "a\U0001f600", "title": "xy", "created_at": ""}),
    ]
    now = F.to_timestamp(F.lit("2024-01-03T00:00:00Z"))
    df = enrich.clean_and_enrich(enrich.parse_messages(messages(spark, vals)), as_of=now)
    a, b, c = df.orderBy("id").collect()
    assert (a["label_count"], a["has_labels"], a["is_bug"], a["is_closed"], a["has_body"], a["body_length"]) == (None, None, None, None, False, 0)
    assert (b["is_bug"], b["has_body"], b["is_closed"], b["has_assignees"], b["age_hours"]) == (True, False, False, False, 24.0)
    assert b["time_to_close_hours"] == -24.0
    assert (c["is_bug"], c["body_length"], c["title_length"], c["created_at"], c["age_hours"]) == (False, 2, 2, None, None)
    old = enrich.clean_and_enrich(enrich.parse_messages(messages(spark, vals)), null_labels_as_minus_one=True)
    assert old.orderBy("id").first()["label_count"] == -1
    assert len(df.columns) == 4 + 25 + 15


def test_four_readings_of_bug(spark):
    df = spark.createDataFrame([(["Kind/Bug"],), (["bug"],), (["debug me"],), (None,)], "labels array<string>")
    df = df.withColumn("labels_str", F.array_join("labels", " "))
    got = df.select(
        labels.has_exact("bug"), labels.any_matches("bug"), labels.joined_contains("BUG")
    ).collect()
    assert [tuple(r) for r in got] == [
        (False, True, True), (True, True, True), (False, True, True), (None, False, False)
    ]


def test_normalize_issue_and_live_variant(spark):
    rec = {
        "id": 1, "number": 3, "user": {"login": "ann"}, "labels": [{"name": "bug"}, {"name": ""}, {"name": None}, None],
        "assignees": [{"login": "bo"}, {"login": None}], "milestone": {"title": "v1"}, "pull_request": {},
    }
    df = spark.read.schema(ISSUE_API).json(spark.sparkContext.parallelize([json.dumps(rec), json.dumps({"id": 2, "pull_request": {"url": "u"}})]))
    df = df.withColumn("repo_full_name", F.lit("o/r"))
    one, two = normalize.normalize_issues(df).orderBy("id").collect()
    assert (one["user_login"], one["labels"], one["assignees"], one["num_assignees"]) == ("ann", ["bug"], ["bo"], 2)
    assert (one["milestone"], one["is_pull_request"], one["first_comment_at"]) == ("v1", False, None)
    assert (two["labels"], two["num_assignees"], two["is_pull_request"], two["user_login"]) == ([], 0, True, None)
    live = normalize.normalize_live_issues(df).orderBy("id").first()
    assert live["labels"] == ["bug", "", None] and live["assignees"] == ["bo", None]


def test_normalize_repo(spark):
    rec = {"id": 1, "full_name": "o/r", "owner": {"login": "o"}, "license": {"spdx_id": "MIT"}}
    df = spark.read.schema(REPO_API).json(spark.sparkContext.parallelize([json.dumps(rec), json.dumps({"id": 2})]))
    one, two = normalize.normalize_repos(df).orderBy("id").collect()
    assert (one["owner_login"], one["license"], one["topics"]) == ("o", "MIT", [])
    assert (two["owner_login"], two["license"]) == (None, None)


def test_paths_tags_and_text(spark):
    paths = [
        "data/raw/issues/apache/spark.jsonl", "x/issues_a__b.c_20240101_010203.jsonl",
        "issues/a/b/c.jsonl", "issues/a/issues_o__r_20240101_010203.jsonl", "nothing.jsonl",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(text.repo_from_path("p")).collect()]
    assert got == ["apache/spark", "a/b.c", None, "o/r", None]
    one = spark.range(1)
    tag, safe, bare, items = one.select(
        text.model_tag(F.lit("org/né w-1.0")), text.file_safe_repo(F.lit("a/b c@@d")),
        text.clean_markup(F.lit("\n<p>a\nb</p> ")), text.split_items(F.lit("a , b,,c ")),
    ).first()
    assert (tag, safe, bare, items) == ("né_w-1.0", "a__b_c_d", "a b", ["a", "b", "", "c"])
    assert one.select(text.org_of(F.lit("plain"))).first()[0] is None


def test_triage_rules(spark):
    df = spark.createDataFrame([(1, 0.31, 0.0), (2, 0.2, -5.0), (3, None, 1.0)], "id int, p double, r double")
    a, b, c = decide.triage(df).orderBy("id").collect()
    assert a["is_fast"] and abs(a["est_days"] - 29.0) < 1e-9 and a["shown"] == "29.0 days"
    assert not b["is_fast"] and b["est_days"] == 40.0 and b["shown"] == "> 30 days"
    assert c["est_days"] is None
    bands = [r[0] for r in df.orderBy("id").select(decide.risk_band("p")).collect()]
    assert bands == ["green", "red", None]


def test_kpis_on_edge_tables(spark):
    empty = spark.createDataFrame([], "state string, labels_str string, created_at timestamp, closed_at timestamp")
    assert kpis.open_ratio(empty).first()["open_pct"] == 0.0
    assert kpis.bug_share(empty).first()["bug_pct"] == 0.0
    assert kpis.velocity(empty).first()["avg_days"] is None
    assert kpis.daily_counts(empty).count() == 0
    one = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    hist = kpis.histogram(one, "v").collect()
    assert len(hist) == 50 and sum(r["n"] for r in hist) == 2
    gaps = spark.sql("SELECT explode(array(timestamp'2024-01-01 05:00:00', timestamp'2024-01-04 01:00:00')) AS created_at")
    assert [r["n"] for r in kpis.daily_counts(gaps).orderBy("day").collect()] == [1, 0, 0, 1]
    audit = kpis.audit_columns(
        spark.sql("SELECT timestamp'2024-01-02' AS ` Created_At`, timestamp'2024-01-01' AS closed_at UNION ALL SELECT timestamp'2024-01-02', null")
    ).collect()
    assert sorted(str(r["days_to_close"]) for r in audit) == ["0.0", "None"]


def test_labels_as_objects_and_strings(spark):
    recs = [{"id": 1, "labels": ["bug", {"name": "a"}, {"name": None}, {"name": ""}, None]}, {"id": 2, "labels": None}]
    df = spark.read.schema(ISSUE_API).json(spark.sparkContext.parallelize([json.dumps(r) for r in recs]))
    df = df.withColumn("repo_full_name", F.lit("o/r"))
    got = {r["id"]: r["labels"] for r in normalize.normalize_issues(df).collect()}
    assert got == {1: ["bug", "a"], 2: []}
    live = {r["id"]: r["labels"] for r in normalize.normalize_live_issues(df).collect()}
    assert live == {1: ["a", None, ""], 2: []}
    plain = spark.createDataFrame([(1, ["x", None])], "id long, labels array<string>").withColumn("repo_full_name", F.lit("o/r"))
    assert normalize.normalize_issues(plain).first()["labels"] == ["x"]
