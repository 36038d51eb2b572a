"""Emit-once with managed state: restarts, a start from the store, expiry."""

import json
import time

from pyspark.sql import functions as F

from issuelab.streaming import jobs, once


def land(path, name, ids):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps({"id": i, "n": k}) for k, i in enumerate(ids)))


def run(spark, src, out, checkpoint, **kw):
    stream = spark.readStream.schema("id long, n int").option("maxFilesPerTrigger", 1).json(str(src))
    jobs.start_log(once.emit_new(stream, **kw), str(out), str(checkpoint)).awaitTermination()
    return sorted((r["id"], r["n"]) for r in spark.read.parquet(str(out)).collect())


def test_once_over_restarts_and_fresh_checkpoints(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(once, "BUCKETS", 5)
    src, out = tmp_path / "src", tmp_path / "out"
    land(src, "a.json", [1, 2, 2, None, 3])
    land(src, "b.json", [3, 4])
    sent = run(spark, src, out, tmp_path / "ck")
    assert [i for i, _ in sent] == [1, 2, 3, 4] and len(sent) == 4
    land(src, "c.json", [4, 1, 5])
    assert [i for i, _ in run(spark, src, out, tmp_path / "ck")] == [1, 2, 3, 4, 5]
    # Another checkpoint, with what was sent before: nothing is sent again, only what is new.
    land(src, "d.json", [5, 6, 6])
    again = run(spark, src, tmp_path / "out2", tmp_path / "ck2", known=spark.read.parquet(str(out)))
    assert [i for i, _ in again] == [6]
    full = spark.read.parquet(str(out)).select(F.col("id")).union(spark.read.parquet(str(tmp_path / "out2")).select("id"))
    assert run(spark, src, tmp_path / "out3", tmp_path / "ck3", known=full) == []


def follow(spark, src, out, checkpoint, done, **kw):
    """Run until ``done`` holds for the ids sent; a query with expiry has a batch to run at any time."""
    stream = spark.readStream.schema("id long, n int").json(str(src))
    query = jobs.start_log(once.emit_new(stream, **kw), str(out), str(checkpoint), "1 second")
    try:
        for _ in range(60):
            time.sleep(1)
            sent = [r["id"] for r in spark.read.schema("id long, n int").parquet(str(out)).collect()] if out.exists() else []
            if done(sent):
                return sent
        raise AssertionError(f"sent: {sent}")
    finally:
        query.stop()


def test_ids_are_forgotten_after_a_while(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(once, "BUCKETS", 1)
    src, out = tmp_path / "src", tmp_path / "out"
    land(src, "a.json", list(range(20)))
    follow(spark, src, out, tmp_path / "ck", lambda ids: len(ids) == 20, keep_ms=1500)
    time.sleep(2)
    land(src, "b.json", [3, 50])
    sent = follow(spark, src, out, tmp_path / "ck", lambda ids: 50 in ids, keep_ms=1500)
    assert sent.count(3) == 2
    land(src, "c.json", [50, 51])
    sent = follow(spark, src, tmp_path / "out2", tmp_path / "ck2", lambda ids: 51 in ids, keep_ms=600_000)
    assert sent.count(50) == 1 and sent.count(3) == 1


def test_a_session_built_elsewhere(spark, tmp_path, monkeypatch):
    """Spark's default state store holds no maps; the operator sets the one it needs."""
    monkeypatch.setattr(once, "BUCKETS", 3)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        land(tmp_path / "src", "a.json", [1, 2, 2])
        known = spark.createDataFrame([(1,)], "id long")
        assert [i for i, _ in run(spark, tmp_path / "src", tmp_path / "out", tmp_path / "ck", known=known)] == [2]
    finally:
        spark.conf.set(name, before)
