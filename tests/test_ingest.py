"""Incremental collection, dumps, store and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from issuelab.functions import timing
from issuelab.operators import idsets, ingest, normalize
from issuelab.plans.dataset import build_dataset
from issuelab.schemas import ISSUE_RAW
from issuelab.sources import dumps, readers, writers
from issuelab.streaming import jobs, store


@pytest.fixture(scope="module")
def issues(spark):
    """One repository with 350 issues, one with exactly 100, one with 3."""
    rows = []
    for repo, n in (("o/big", 350), ("o/full", 100), ("o/small", 3)):
        for i in range(n):
            rows.append((repo, len(rows), i, i % 4 == 0, 0 if i % 5 == 0 else 2, 1_700_000_000 + (i * 37) % 211))
    df = spark.createDataFrame(
        rows, "repo_full_name string, id long, number int, is_pull_request boolean, comments int, t long"
    )
    return rows, df.withColumn("updated_ts", F.timestamp_seconds("t")).repartition(7)


def test_page_cap_and_truncated_flag(issues):
    rows, df = issues
    want = set()
    for repo in ("o/big", "o/full", "o/small"):
        own = sorted((r[5], r[1]) for r in rows if r[0] == repo)
        want |= {i for _, i in own[:200]}
    assert {r["id"] for r in ingest.first_pages(df, 2).collect()} == want
    report = {r["repo_full_name"]: (r["collected"], r["truncated"]) for r in ingest.page_report(df, 1).collect()}
    assert report == {"o/big": (100, True), "o/full": (100, True), "o/small": (3, True)}
    report = {r["repo_full_name"]: r["truncated"] for r in ingest.page_report(df, 2).collect()}
    assert report == {"o/big": True, "o/full": False, "o/small": False}


def test_first_comment_only_for_the_first_eligible(issues, spark):
    rows, df = issues
    comments = df.select(F.col("id").alias("issue_id"), F.explode(F.array(F.lit(9), F.lit(5))).alias("k"))
    comments = comments.withColumn("comment_ts", F.timestamp_seconds(F.col("issue_id") * 100 + F.col("k")))
    got = ingest.with_first_comment(df, comments, 50).select("id", F.unix_timestamp("first_comment_ts").alias("s"))
    got = {r["id"]: r["s"] for r in got.collect()}
    assert len(got) == len(rows)
    for repo in ("o/big", "o/full", "o/small"):
        own = sorted((r[5], r[1]) for r in rows if r[0] == repo and not r[3] and r[4] > 0)
        chosen = {i for _, i in own[:50]}
        for r in rows:
            if r[0] == repo:
                assert got[r[1]] == (r[1] * 100 + 5 if r[1] in chosen else None)


def test_cursor_rules(spark):
    rows = [("o/a", "2024-01-02T00:00:00Z", 1), ("o/a", "2024-01-02T02:00:00+02:00", 0), ("o/a", "bad", 2), ("o/b", None, 3)]
    df = spark.createDataFrame(rows, "repo_full_name string, updated_at string, ingest_seq long")
    got = {r[0]: r[1] for r in ingest.newest_update(df).collect()}
    assert got == {"o/a": "2024-01-02T02:00:00+02:00"}  # equal instants: the first row's spelling
    assert {r[0]: r[1] for r in ingest.next_cursors(df, 60).collect()} == {"o/a": "2024-01-01T23:59:00Z"}
    one = spark.range(1).select(timing.step_back(F.lit("never"), 60), timing.step_back(F.lit("2024-01-01T00:00:00Z"), -5))
    assert tuple(one.first()) == ("never", "2024-01-01T00:00:00Z")


def test_state_upsert_keeps_old_values(spark):
    old = spark.createDataFrame([("a", "s1", 5), ("b", "s2", 6)], "repo_full_name string, since string, n int")
    new = spark.createDataFrame([("b", None, True), ("c", "s3", False)], "repo_full_name string, since string, flag boolean")
    got = {r[0]: tuple(r)[1:] for r in ingest.upsert_state(old, new).collect()}
    assert got == {"a": ("s1", 5, None), "b": ("s2", 6, True), "c": ("s3", None, False)}


def test_unsent_takes_first_arrival_once(spark):
    batch = spark.createDataFrame([(1, 2, "late"), (1, 1, "early"), (2, 3, "sent")], "id long, seq long, state string")
    sent = spark.createDataFrame([(2,), (2,)], "id long")
    assert [tuple(r) for r in ingest.unsent(batch, sent).collect()] == [(1, 1, "early")]


def test_repo_selection(spark):
    rows = [("a/x", 0, 1, False), ("b/y", 0, 2, None), (None, 0, 3, True), ("a/x", 1, 0, True), ("", 1, 1, True), ("c/z", 1, 2, True)]
    df = spark.createDataFrame(rows, "full_name string, src_rank int, seq int, has_issues boolean")
    seen = [r["full_name"] for r in ingest.first_seen_repos(df, 2, ["src_rank", "seq"]).collect()]
    assert seen == ["a/x", "b/y"]
    assert [r["full_name"] for r in ingest.collectable_repos(df, 5, ["src_rank", "seq"]).collect()] == ["b/y", "a/x"]


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_mixed_layout_merge(spark, tmp_path):
    root = str(tmp_path)
    write(root, "array.json", '[\n {"id": 1, "labels": ["a"]},\n {"id": 2}\n]')
    write(root, "object.json", '{\n "id": 3,\n "title": "x"\n}\n')
    write(root, "one line.json", '{"id": 4}')
    write(root, "lines.jsonl", '{"id": 5}\n\n  {"id": 6}\r\nnot json\n{"id": 7}\n')
    write(root, "badfirst.ndjson", '{"id": 8\n{"id": 9}\n')
    write(root, "empty.json", "")
    write(root, "latin.jsonl", b'{"id": 10, "title": "caf\xe9"}\n')
    write(root, "other.txt", '{"id": 11}\n')
    merged = dumps.merge_dumps(spark, root)
    assert sorted(r["id"] for r in merged.records.collect()) == [1, 2, 3, 4, 5, 6, 7, 9]
    account = {os.path.basename(r["file"]): (r["status"], r["records"], r["bad_lines"]) for r in merged.report.collect()}
    assert account["array.json"] == ("document", 2, 0) and account["object.json"] == ("document", 1, 0)
    assert account["lines.jsonl"] == ("lines", 3, 1) and account["badfirst.ndjson"] == ("lines", 1, 1)
    assert account["latin.jsonl"][0] == "skipped" and account["empty.json"] == ("lines", 0, 0)
    assert account["one%20line.json"] == ("lines", 1, 0) and len(account) == 7
    total = dumps.report_totals(merged.report).first()
    assert (total["records"], total["bad_lines"], total["skipped"]) == (8, 2, 1)
    with pytest.raises(ValueError):
        dumps.merge_dumps(spark, root, strict=True)


MERGE_CASES = {
    # name: (content, status, records, bad lines, ids)
    "two_values.json": ('[{"id":1}]\n{"id":2}', "lines", 2, 0, [None, 2]),
    "array_then_line.json": ('[\n{"id":1}\n]\n{"id":2}', "lines", 2, 2, [1, 2]),
    "two_pretty.json": ('{\n"id":1,\n"x":2\n}\n{\n"id":2,\n"x":3\n}', "lines", 0, 8, []),
    "mistyped.json": ('[\n{"id":1,\n"comments":"n/a"},\n{"id":2,\n"number":50.0}\n]', "document", 2, 0, [1, 2]),
    "trailing.jsonl": ('{"id":1}{"id":2}\n{"id":3} trailing\n{"id":4},\n{"id":5}', "lines", 1, 3, [5]),
    "fragment.jsonl": ('"id": 10\n{"id":6}', "lines", 1, 1, [6]),
    "odd_values.jsonl": ('{"id":7,"id":8}\n{"id":9,"x":NaN}', "lines", 2, 0, [8, 9]),
    "one_line_array.json": ('[{"id":1},{"id":2}]', "document", 2, 0, [1, 2]),
    "brackets.json": ('[\n{"id":1}\n{"id":2}\n]', "lines", 2, 2, [1, 2]),
}


def test_merge_counts_every_record_once(spark, tmp_path):
    for name, (content, *_) in MERGE_CASES.items():
        write(str(tmp_path), name, content)
    merged = dumps.merge_dumps(spark, str(tmp_path))
    account = {os.path.basename(r["file"]): (r["status"], r["records"], r["bad_lines"]) for r in merged.report.collect()}
    ids = {}
    for r in merged.records.collect():
        ids.setdefault(os.path.basename(r["file"]), []).append(r["id"])
    for name, (_, status, records, bad, want) in MERGE_CASES.items():
        assert account[name] == (status, records, bad), name
        assert sorted(ids.get(name, []), key=str) == sorted(want, key=str), name
    dumps.write_merged(merged, f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out/records").count() == sum(c[2] for c in MERGE_CASES.values())
    assert spark.read.json(f"{tmp_path}/out/report").count() == len(MERGE_CASES)


def test_cursor_step_on_a_read_dump(spark, tmp_path):
    write(str(tmp_path), "a.jsonl", '{"id":1,"repo_full_name":"o/a","updated_at":"2024-01-02T00:00:00Z"}\n'
          '{"id":2,"repo_full_name":"o/a","updated_at":"2024-01-03T00:00:00Z"}\n'
          '{"id":3,"repo_full_name":"o/b","updated_at":"2024-01-03T00:00:00Z"}\n')
    issues = readers.read_jsonl(spark, str(tmp_path)).withColumn("updated_ts", timing.parse_utc("updated_at"))
    cursors = spark.createDataFrame([("o/b", "2023-01-01T00:00:00Z"), ("o/c", "2023-01-01T00:00:00Z")], "repo_full_name string, since string")
    failed = spark.createDataFrame([("o/b", "Timeout")], "repo_full_name string, kind string")
    state = ingest.collect_step(issues, cursors, "2020-01-01T00:00:00Z", 1, 60, run_at=F.lit("now"), failed=failed)
    got = {r["repo_full_name"]: (r["since"], r["last_collected_count"], r["last_status"]) for r in state.collect()}
    assert got == {
        "o/a": ("2024-01-02T23:59:00Z", 2, "ok"),
        "o/b": ("2023-01-01T00:00:00Z", 0, "error: Timeout"),
        "o/c": ("2023-01-01T00:00:00Z", 0, "ok"),
    }
    assert ingest.run_summary(state).first()["errors"] == 1


def test_late_batch_after_compaction(spark, tmp_path):
    path = str(tmp_path / "store")
    doc = lambda i, t: spark.createDataFrame([(i, t)], "id long, updated_at string")
    store.write_batch(doc(1, "2024-01-01"), 0, path)
    store.compact(spark, path, through=5)
    store.write_batch(doc(2, "2024-01-01"), 1, path)
    assert {r["id"] for r in store.read_current(spark, path).collect()} == {1, 2}
    store.compact(spark, path, through=1)
    with pytest.raises(ValueError, match="folded already"):
        store.compact(spark, path, through=0)

def test_jsonl_scan_order_and_failfast(spark, tmp_path):
    root = str(tmp_path)
    write(root, "a/x.jsonl", '{"id": 1, "number": 1}\n\n{"id": 2, "number": 1}\n')
    write(root, "b/y.jsonl", '{"id": 3}\n')
    df = readers.load_issues(spark, "jsonl", [root + "/none", root])
    assert [r["id"] for r in df.orderBy("ingest_seq").collect()] == [1, 2, 3]
    assert [r["id"] for r in readers.read_sample(spark, root, 2).collect()] == [1, 2]
    counts = {os.path.basename(r["path"]): r["n"] for r in readers.line_counts(spark, root).collect()}
    assert counts == {"x.jsonl": 3, "y.jsonl": 1}
    write(root, "c.jsonl", "{oops\n")
    with pytest.raises(Exception):
        readers.read_jsonl(spark, root).collect()
    with pytest.raises(ValueError):
        readers.load_issues(spark, "ftp", root)


def test_dataset_build(spark, tmp_path):
    line = lambda **k: json.dumps({"repo_full_name": "o/r", "created_at": "2024-01-01T00:00:00Z", **k})
    write(str(tmp_path), "in/i.jsonl", "\n".join([line(number=1, title="a"), line(number=1, title="b"), line(number=2, is_pull_request=True)]))
    built = build_dataset(spark, "jsonl", f"{tmp_path}/in", f"{tmp_path}/out")
    assert [(r["row_id"], r["title"]) for r in built.collect()] == [("o/r#1", "b")]
    rec = json.loads(spark.read.text(f"{tmp_path}/out/issues_clean_latest_jsonl").first()[0])
    assert rec["created_ts"] == "2024-01-01T00:00:00+00:00" and rec["closed_ts"] is None
    meta = spark.read.json(f"{tmp_path}/out/dataset_meta").first()
    assert meta["n_rows"] == 1 and len(meta["columns"]) == 29


def test_dataset_from_a_store(spark, tmp_path):
    rows = [("o/r", 1, "2024-01-01T00:00:00Z", "x"), ("o/r", 2, "2024-01-02T00:00:00Z", "y")]
    df = spark.createDataFrame(rows, "repo_full_name string, number long, created_at string, _id string")
    df.write.parquet(f"{tmp_path}/store")
    built = build_dataset(spark, "store", f"{tmp_path}/store", f"{tmp_path}/out")
    assert sorted(r["row_id"] for r in built.collect()) == ["o/r#1", "o/r#2"] and "_id" not in built.columns


def test_state_versions_and_run_log(spark, tmp_path):
    from issuelab.plans import training

    one = spark.createDataFrame([("o/r", "s1")], "repo_full_name string, since string")
    path = writers.write_state(one, str(tmp_path), 1)
    two = ingest.upsert_state(spark.read.parquet(path), one.withColumn("since", F.lit("s2")))
    assert spark.read.parquet(writers.write_state(two, str(tmp_path), 2)).first()["since"] == "s2"
    params = training.parameters(spark, {"depth": 4})
    measured = spark.createDataFrame([("test_mae", 1.5)], "name string, value double")
    for run in ("a", "b"):
        training.append_run(training.run_record(run, "stage2", params, measured), f"{tmp_path}/runs")
    got = {(r["run_id"], r["kind"], r["name"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert got == {(r, k, n, v) for r in "ab" for k, n, v in (("param", "depth", "4"), ("metric", "test_mae", "1.5"))}


def test_dashboard_scan_labels(spark):
    df = spark.createDataFrame([(["a", "b"], ""), (None, "2024-01-01")], "labels array<string>, created_at string")
    got = readers.dashboard_issues(df).collect()
    assert [r["labels_str"] for r in got] == ["a, b", "None"] and got[0]["created_at"] is None
    assert readers.dashboard_issues(df.drop("labels")).first()["labels_str"] == ""


def test_embedding_bundle_pointer(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0])], "row_id string, embedding array<float>")
    writers.write_embeddings(df, str(tmp_path), "x/m one")
    writers.write_embeddings(df.withColumn("row_id", F.lit("b")), str(tmp_path), "x/m-two")
    assert [r["row_id"] for r in readers.read_embeddings(spark, str(tmp_path)).collect()] == ["b"]
    tags = {r["model_tag"] for r in spark.read.parquet(f"{tmp_path}/vectors").collect()}
    assert tags == {"m_one", "m-two"}


# --- store and streams ---------------------------------------------------------------------------


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, state string, u long").select(
        "id", "state", F.timestamp_seconds("u").alias("updated_at")
    )


def current(spark, path):
    return sorted((r["id"], r["state"]) for r in store.read_current(spark, path).collect())


def test_store_upsert_replay_and_compaction(spark, tmp_path):
    path = str(tmp_path)
    first = batch(spark, [(1, "open", 10), (1, "closed", 20), (2, "open", 5), (3, "open", None)])
    store.write_batch(first, 0, path)
    store.write_batch(batch(spark, [(2, "closed", 9), (1, "stale", 15)]), 1, path)
    want = [(1, "closed"), (2, "closed"), (3, "open")]
    assert current(spark, path) == want
    store.write_batch(first, 0, path)  # the same batch once more
    assert current(spark, path) == want
    assert store.compact(spark, path, through=1) == 1
    assert current(spark, path) == want
    store.write_batch(batch(spark, [(3, "closed", 30)]), 2, path)
    assert current(spark, path) == [(1, "closed"), (2, "closed"), (3, "closed")]
    assert store.compact(spark, path, through=2) == 2
    assert current(spark, path) == [(1, "closed"), (2, "closed"), (3, "closed")]


def land(spark, path, name, records):
    lines = [
        json.dumps({"key": str(r["id"]), "value": json.dumps(r), "timestamp": "2024-01-01T00:00:00Z", "partition": 0, "offset": i})
        for i, r in enumerate(records)
    ]
    write(path, name, "\n".join(lines) + "\n")


def rec(i, **k):
    return {"id": i, "repo_full_name": "o/r", "number": i, "state": "open", "created_at": "2024-01-01T00:00:00Z", **k}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    land(spark, src, "1.json", [rec(1), rec(2, labels=["bug"]), {"id": 3}])
    now = F.to_timestamp(F.lit("2024-02-01T00:00:00Z"))
    run = lambda: jobs.start_log(jobs.enriched(readers.read_stream(spark, src), as_of=now), out, ck).awaitTermination()
    run()
    land(spark, src, "2.json", [rec(4)])
    run()
    static = spark.read.schema(readers.read_stream(spark, src).schema).json(src)
    want = jobs.enriched(static, as_of=now)
    streamed = spark.read.parquet(out)
    assert sorted(map(str, streamed.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert streamed.count() == 3


def test_stream_upsert_and_backfill(spark, tmp_path):
    src, path, ck = (f"{tmp_path}/{n}" for n in ("src", "store", "ck"))
    land(spark, src, "1.json", [rec(1, updated_at="2024-01-02T00:00:00Z", state="closed"), rec(2)])
    static = spark.read.schema(readers.read_stream(spark, src).schema).json(src)
    history = jobs.enriched(static.where("key = '2'"))
    live = jobs.enriched(readers.read_stream(spark, src))
    jobs.backfill_then_live(history, live, path, ck).awaitTermination()
    assert current(spark, path) == [(1, "closed"), (2, "open")]
    land(spark, src, "2.json", [rec(2, updated_at="2024-01-05T00:00:00Z", state="closed")])
    jobs.backfill_then_live(history, live, path, ck).awaitTermination()
    assert current(spark, path) == [(1, "closed"), (2, "closed")]


def test_backfill_resumes_where_it_stopped(spark, tmp_path, monkeypatch):
    old, new, path, ck = (f"{tmp_path}/{n}" for n in ("old", "new", "store", "ck"))
    for k in range(4):
        land(spark, old, f"{k}.json", [rec(k), rec(10 + k)])
    land(spark, new, "1.json", [rec(1, state="closed", updated_at="2024-03-01T00:00:00Z"), rec(50)])
    write, written = jobs.write_batch, []

    def failing(df, batch_id, where):
        if batch_id == 2 and 2 not in written:
            written.append(2)
            raise RuntimeError("stopped in the middle")
        written.append(batch_id)
        write(df, batch_id, where)

    monkeypatch.setattr(jobs, "write_batch", failing)
    run = lambda: jobs.resume_backfill(*(jobs.enriched(readers.read_stream(spark, p)) for p in (old, new)), path, ck).awaitTermination()
    with pytest.raises(Exception, match="stopped"):
        run()
    assert written == [0, 1, 2] and store.handed_over(spark, path) is None
    run()
    assert written == [0, 1, 2, 2, 3, 4] and store.handed_over(spark, path) == 4
    land(spark, new, "2.json", [rec(51)])
    run()
    assert written[6:] == [5]
    states = dict(current(spark, path))
    assert sorted(states) == [0, 1, 2, 3, 10, 11, 12, 13, 50, 51] and states[1] == "closed" and states[0] == "open"


def test_sample_opens_the_first_files_only(spark, tmp_path):
    for k in range(6):
        write(str(tmp_path), f"a {k}.jsonl", "\n".join(json.dumps({"id": 10 * k + i}) for i in range(10)))
    write(str(tmp_path), "z.jsonl", "no json")  # an error if it is opened
    ids = lambda n: [r["id"] for r in readers.read_sample(spark, str(tmp_path), n).collect()]
    assert ids(7) == list(range(7)) and ids(25) == list(range(25))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        ids(100)
    write(str(tmp_path), "z.jsonl", "")
    assert ids(100) == list(range(60))


def test_id_sets(spark):
    values = [0, 1, 7, 8, 32768, 32769, -1, -5, 10**15, None, 1]
    ids = idsets.id_set(spark.createDataFrame([(v,) for v in values], "id long"))
    more = idsets.id_set(spark.range(100, 200))
    every = idsets.union(ids, more)
    assert idsets.size(every).first()["n"] == 109 and idsets.size(ids.limit(0)).first()["n"] == 0
    asked = [(v, "x") for v in [*values, 2, 6, 9, 32767, 32770, -2, 99, 100, 199, 200, 10**15 + 1]]
    rows = spark.createDataFrame(asked, "id long, _other string")
    got = sorted((r["id"] for r in idsets.without(rows, every).collect()), key=str)
    assert got == sorted([None, 2, 6, 9, 32767, 32770, -2, 99, 200, 10**15 + 1], key=str)
    assert idsets.without(rows, every.limit(0)).count() == len(asked)


def test_emit_once_survives_restart(spark, tmp_path):
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    run = lambda: jobs.start_log(
        jobs.emit_once(jobs.enriched(readers.read_stream(spark, src)).select("id", "state")), out, ck
    ).awaitTermination()
    land(spark, src, "1.json", [rec(1), rec(1)])
    run()
    land(spark, src, "2.json", [rec(1, state="closed"), rec(2)])
    run()
    assert sorted((r["id"], r["state"]) for r in spark.read.parquet(out).collect()) == [(1, "open"), (2, "open")]


def test_broker_payload(spark):
    df = spark.createDataFrame([(7, None)], "id long, body string")
    row = writers.message_payload(df).first()
    assert (row["key"], json.loads(row["value"])) == ("7", {"id": 7, "body": None})


def test_staging_needs_a_shared_folder(monkeypatch):
    from issuelab import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Fake:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.staging_root(Fake())


def test_raw_schema_has_25_fields(spark):
    assert len(ISSUE_RAW) == 25
    assert normalize.normalize_issues(spark.createDataFrame([(1, "o/r")], "id long, repo_full_name string")).schema.names == ISSUE_RAW.names
