"""The classifier: gradients that learn, accuracy on held-out rows, defined scores."""

import numpy as np
from pyspark.sql import functions as F

from issuelab.llm import toxicity

from .awkward import awkward_docs, empty_docs, with_clashes


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").withColumn("held", toxicity.held_out(F.col("doc_id")))
    rows = rows.select("held", "toxic", "predicted", "score").toPandas()
    for held, recall, false in ((False, 0.85, 0.03), (True, 0.5, 0.1)):
        own = rows[rows["held"] == held]
        assert own[own["toxic"] == 1]["predicted"].mean() >= recall
        assert own[own["toxic"] == 0]["predicted"].mean() <= false
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.5) == (rows["predicted"] == 1)).all()


def test_chunks_of_long_texts_score_alike(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 500, (n, 3)) for n in (40, 3, 200, 0, 1, 700)]
    model = toxicity.train(texts, np.array([0, 1, 0, 1, 0, 1], np.float32), toxicity.Training(buckets=500, epochs=2))
    whole = [toxicity.logit(model, t) for t in texts]
    monkeypatch.setattr(toxicity, "_CHUNK", 16)
    np.testing.assert_allclose([toxicity.logit(model, t) for t in texts], whole, rtol=1e-4)


def test_fold_is_crc32_of_the_id(spark):
    from zlib import crc32

    got = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_awkward_tables(spark):
    docs = with_clashes(awkward_docs(spark))
    rows = [(i, f"fine words number {i} here", i % 2) for i in range(10, 60)]
    text = lambda i, t, y: (i, t + (" vile nasty" if y else ""), None, None, None)
    more = spark.createDataFrame([text(*r) for r in rows], awkward_docs(spark).schema)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (10, None), (11, 1)], "doc_id long, toxic int")
    model = toxicity.fit(awkward_docs(spark).unionByName(more), labels)
    got = toxicity.score(docs, model)
    assert got.count() == docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert set(got.columns) == set(docs.columns) and got.where("doc_id = 1").select("score").distinct().count() == 1
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.fit(empty_docs(spark), labels) is None
    assert toxicity.score(docs, None).where("predicted = 0").count() == docs.count()


def test_a_labelled_text_beyond_the_room_changes_nothing_else(spark):
    """It is no example, and the others are; without any model a text keeps score 0."""
    rows = [(i, f"vile filthy scum number{i}" if i % 2 else f"kind gentle friend number{i}", i % 2) for i in range(1, 200)]
    huge = (900, "long " * 5000, 1)
    small = toxicity.Training(sample_words=1500, epochs=2)
    make = lambda rs: (spark.createDataFrame([r[:2] for r in rs], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rs], "doc_id long, toxic int"))
    with_huge = toxicity.fit(*make([*rows, huge]), small)
    without = toxicity.fit(*make(rows), small)
    assert with_huge is not None and all(np.array_equal(a, b) for a, b in zip(with_huge.filters, without.filters))
    assert np.array_equal(with_huge.vectors, without.vectors)
    assert toxicity.fit(*make([huge]), small) is None


def test_every_labelled_row_counts(spark):
    """Words that only rows beyond the first shards hold have their log-odds, and all rows train and calibrate."""
    rows = [(i, f"plain words about {'vile' if i % 4 == 0 else 'kind'}{'abcdefghij'[i // 40 % 10]} things", int(i % 4 == 0)) for i in range(1, 400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    t = toxicity.Training(sample_rows=30)
    used = []
    trained = toxicity._trained
    toxicity._trained = lambda examples, start, *rest: used.append((examples.count(), rest[1], start)) or trained(examples, start, *rest)
    try:
        model = toxicity.fit(docs, labels, t)
    finally:
        toxicity._trained = trained
    n = docs.where(~toxicity.held_out(F.col("doc_id"))).count()
    assert used[0][0] > 0.7 * n and used[0][1] > 5
    scored = toxicity.score(docs, model).join(labels, "doc_id")
    assert scored.where("predicted != toxic").count() == 0
    again = toxicity.fit(docs, labels, t)
    assert np.array_equal(model.vectors, again.vectors) and np.array_equal(model.shifts, again.shifts)


def test_words_are_hashed_once_and_only_of_labelled_texts(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    plan = toxicity._examples(docs, labels, toxicity.Training(), "text")._jdf.queryExecution().optimizedPlan().toString()
    hashing = [k for k, line in enumerate(plan.splitlines()) if "xxhash64(1, " in line]
    joining = [k for k, line in enumerate(plan.splitlines()) if "Join" in line]
    assert plan.count("xxhash64(1, ") == 1 and hashing[0] < joining[0]


def test_words_are_the_runs_of_letters(spark):
    texts = ["", "  ", "One two", "-a1b--C ", "\u00c9t\u00e9 na\u00efve_x", "\U00010400\U0001f600z \u0130I", "tail 9", "\u4e2d\u6587 e\u0301a"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    number = lambda w, seed: F.pmod(F.xxhash64(F.lit(seed), w), F.lit(500)).cast("int")
    hashed = F.flatten(F.transform(words, lambda w: F.array(number(w, 1), number(F.substring(w, 1, 6), 2), number(F.right(w, F.lit(5)), 3))))
    assert rows.where(~toxicity.features(F.col("text"), 500).eqNullSafe(hashed)).count() == 0
