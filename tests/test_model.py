"""Splits, priors, metrics and the trained stages."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from issuelab.operators import embeddings, features, metrics, priors, splits
from issuelab.plans import training


@pytest.fixture(scope="module")
def timed(spark):
    """103 rows; a third of them share one creation time."""
    rows = [(f"r{i:03d}", 1_700_000_000 + (0 if i % 3 == 0 else i * 60), f"o/{i % 4}", i % 2) for i in range(103)]
    df = spark.createDataFrame(rows, "row_id string, t long, repo_full_name string, y int")
    return rows, df.withColumn("created_ts", F.timestamp_seconds("t")).repartition(5)


def test_time_split_is_ordered_and_sized(timed):
    rows, df = timed
    got = {r["row_id"]: r["split"] for r in splits.with_time_split(df).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = ["train"] * 82 + ["dev"] * 10 + ["test"] * 11
    assert [got[r[0]] for r in order] == want


def test_split_shares_must_sum_to_one(timed):
    with pytest.raises(ValueError):
        splits.with_time_split(timed[1], train=0.8, dev=0.1, test=0.2)


def test_split_with_empty_tail(timed):
    got = splits.with_time_split(timed[1], train=1.0, dev=0.0, test=0.0)
    assert {r["split"] for r in got.collect()} == {"train"}


def test_folds(timed):
    rows, df = timed
    assert splits.fold_starts(103, 5) == [18, 35, 52, 69, 86]
    got = {r["row_id"]: r["fold"] for r in splits.with_time_folds(df, 5).collect()}
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    want = [None if i < 18 else min((i - 18) // 17, 4) for i in range(103)]
    assert [got[i] for i in order] == want
    with pytest.raises(ValueError):
        splits.require_oof(199, 0.8)


def test_fold_priors_see_only_earlier_rows(timed):
    _, df = timed
    folded = splits.with_time_folds(df, 5)
    tables = priors.fold_rate_tables(folded, "y", 5)
    for fold in range(5):
        one = priors.rate_table(splits.train_part(folded, fold), "y")
        want = {(r["repo_full_name"], r["cnt"], r["posrate"]) for r in one.collect()}
        got = {
            (r["repo_full_name"], r["cnt"], r["posrate"])
            for r in tables.where(F.col("for_fold") == fold).collect()
        }
        assert got == want


def test_unseen_repo_gets_global_priors(timed, spark):
    _, df = timed
    fitted = priors.fit_rate_priors(df, "y")
    new = spark.createDataFrame([("n1", "new/repo"), ("n2", "o/1")], "row_id string, repo_full_name string")
    got = {r["row_id"]: r for r in features.join_priors(new, fitted).collect()}
    assert math.isclose(got["n1"]["repo_count_train"], math.log1p(103 / 4))
    assert math.isclose(got["n1"]["repo_posrate_train"], 51 / 103)
    assert math.isclose(got["n2"]["repo_count_train"], math.log1p(26))


def test_all_ttf_missing_fills_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "ttf_hours double")
    assert priors.ttf_fill(df).first()["ttf_fill"] == 0.0


def test_single_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (0,)], "y int")
    assert priors.class_weight(df, "y").first()["scale_pos_weight"] == 3.0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(1500):
        p = rng.randrange(1, 60) / 64
        rows.append((int(rng.random() < p), p))
    return rows, spark.createDataFrame(rows, "y int, p double").repartition(6)


def test_auc_equals_spark_evaluator(scored):
    _, df = scored
    vec = df.select(F.col("y").cast("double").alias("label"), F.col("p").alias("rawPrediction"))
    want = BinaryClassificationEvaluator(numBins=0).evaluate(vec)
    assert math.isclose(metrics.ranking_metrics(df).first()["roc_auc"], want, rel_tol=1e-9)


def test_threshold_and_average_precision_by_brute_force(scored):
    rows, df = scored
    pos = sum(y for y, _ in rows)
    best, ap, last = (-1.0, 0.0), 0.0, 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp = sum(y for y, p in rows if p >= t)
        k = sum(1 for _, p in rows if p >= t)
        prec, rec = tp / k, tp / pos
        best = max(best, (2 * prec * rec / (prec + rec + 1e-12), -t))
        ap += (rec - last) * prec
        last = rec
    got = metrics.best_threshold(df).first()
    assert math.isclose(got["threshold"], -best[1]) and math.isclose(got["f1"], best[0])
    assert math.isclose(metrics.ranking_metrics(df).first()["pr_auc"], ap)


def test_single_class_and_empty_metrics(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, p double")
    row = metrics.classification_metrics(df, 0.95).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert metrics.best_threshold(df.where("p > 2")).first()["threshold"] == 0.5


def test_regression_metrics_constant_target(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 5.0)], "y double, pred double")
    row = metrics.regression_metrics(df).first()
    assert (row["mae"], row["r2"], row["median_ae"], row["acc_within_3d"]) == (1.5, 0.0, 1.5, 1.0)


def test_strict_alignment(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "row_id string")
    vecs = spark.createDataFrame([("a", [1.0, 0.0])], "row_id string, embedding array<float>")
    with pytest.raises(Exception, match="row_id=b"):
        embeddings.align(rows, vecs).collect()
    assert embeddings.align(rows, vecs, strict=False).count() == 1


def test_external_encoder_hook(spark):
    import numpy as np

    df = spark.createDataFrame([("a", "xx"), ("b", None)], "row_id string, text string")
    make = lambda: lambda texts: np.array([[len(t), 3.0] for t in texts])
    got = {r["row_id"]: r["embedding"] for r in embeddings.embed_with(df, make).collect()}
    assert np.allclose(got["a"], [2 / 13**0.5, 3 / 13**0.5]) and got["b"] == [0.0, 1.0]


@pytest.fixture(scope="module")
def table(spark):
    """Issues of which quick closers carry a label."""
    rng = random.Random(5)
    rows = []
    for i in range(1600):
        bug = rng.random() < 0.5
        days = rng.uniform(0, 12) if bug and rng.random() < 0.9 else (rng.uniform(10, 90) if rng.random() < 0.6 else None)
        rows.append((f"o/{i % 5}#{i}", f"o/{i % 5}", i, "t", None, "bug" if bug else "other", 1, days, 1_700_000_000 + i * 977))
    df = spark.createDataFrame(
        rows,
        "row_id string, repo_full_name string, number long, title string, body string, labels_str string, "
        "labels_count int, days_to_close double, t long",
    )
    zero = {c: F.lit(0) for c in ("comments", "num_assignees", "title_len", "body_len", "has_body", "created_dow", "created_hour")}
    return df.withColumns({
        **zero, "created_ts": F.timestamp_seconds("t"), "author_association": F.lit(None).cast("string"),
        "ttf_hours": F.lit(None).cast("double"),
    })


# The fixture is small: a leaf needs less weight than by default.
SMALL = training.Settings(rounds=6, patience=3, folds=2, step=0.3, min_child_weight=1.0, l2=1.0, seed=1)


def test_two_stages_learn_save_and_score(table, spark, tmp_path):
    one, measured, params = training.train_stage1(table, None, SMALL)
    m = {r["name"]: r["value"] for r in measured.collect()}
    assert m["test_roc_auc"] > 0.75 and 0 < one.threshold < 1
    assert {"threshold_from_oof", "scale_pos_weight"} <= {r["name"] for r in params.collect()}
    two, measured, _ = training.train_stage2(table, None, SMALL)
    m = {r["name"]: r["value"] for r in measured.collect()}
    assert m["test_mae"] < m["baseline_test_mae"]
    training.save_bundle(one, f"{tmp_path}/one")
    loaded = training.load_bundle(spark, f"{tmp_path}/one")
    assert (loaded.threshold, loaded.fill, loaded.settings) == (one.threshold, one.fill, one.settings)
    requests = spark.createDataFrame(
        [("q1", "o/1", "t", None, ["bug"], None), ("q2", "new/x", "t", "b", None, None)],
        "row_id string, repo_full_name string, title string, body string, labels array<string>, created_at string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("first_comment_at", "author_association")}).withColumns(
        {c: F.lit(None).cast("int") for c in ("comments", "num_assignees")}
    )
    got = {r["row_id"]: r["p"] for r in training.score_stage1(requests, loaded).collect()}
    assert got["q1"] > got["q2"]
    again = {r["row_id"]: r["p"] for r in training.score_stage1(requests, one).collect()}
    assert got == again


def test_small_steps_grow_many_trees(table):
    """More than one tree, and a lower held-out loss than the first tree has."""
    s = training.Settings(folds=2, step=0.03, patience=5, rounds=40, seed=1)
    rows = training._stage1_rows(table, s).withColumnRenamed("split", "part")
    train = rows.where("part = 'train'")
    fitted = priors.fit_rate_priors(train, "y")
    ready = training._learning_rows(training._with_class_weight(rows, 1.0), fitted, 0.0, s, None)
    model = training._fit({0: (ready, "dev")}, "logistic", s)[0]
    scored = training._probability(model, ready.where("part = 'dev'"))
    loss = lambda m: -training._probability(m, ready.where("part = 'dev'")).agg(
        F.avg(F.when(F.col("y") == 1, F.log("p")).otherwise(F.log(1 - F.col("p"))))
    ).first()[0]
    assert model.getNumTrees > 10 and loss(model) < loss(model.first(1)) and scored.where("p between 0 and 1").count() > 0


def test_scores_that_differ_late_are_calibrated_apart(spark):
    rows = [(0, 0.5), (0, 0.5), (1, 0.50000001), (1, 0.50000001)] * 5
    df = spark.createDataFrame(rows, "y int, p double")
    got = {(r["raw"], r["p"]) for r in training.calibrated(df.withColumn("raw", F.col("p")), training.fit_calibrator(df)).collect()}
    assert got == {(0.5, 0.0), (0.50000001, 1.0)}


def test_requests_without_a_vector_score_null(table, spark):
    s = training.Settings(folds=2, step=0.3, patience=2, rounds=4, seed=1)
    vectors = table.select("row_id", F.array(F.lit(0.5).cast("float"), F.col("number").cast("float")).alias("embedding"))
    one, _, params = training.train_stage1(table, vectors, s)
    assert {r["name"]: r["value"] for r in params.collect()}["embedding_dim"] == "2"
    rows = [(k, "o/1", "t", "b", ["bug"], None, None, None, "x", "1") for k in ("q1", "q2", "q2")]
    requests = spark.createDataFrame(
        rows,
        "row_id string, repo_full_name string, title string, body string, labels array<string>, created_at string, "
        "first_comment_at string, author_association string, comments string, num_assignees string",
    )
    known = spark.createDataFrame([("q1", [0.5, 1.0])], "row_id string, embedding array<float>")
    got = [(r["row_id"], r["p"] is None, r["comments"]) for r in training.score_stage1(requests, one, known).collect()]
    assert sorted(got) == [("q1", False, "x"), ("q2", True, "x"), ("q2", True, "x")]


def test_too_few_rows_for_regression(table):
    with pytest.raises(ValueError, match="too few"):
        training.train_stage2(table.limit(300), None, SMALL)


def test_calibration_is_monotone(scored):
    _, df = scored
    cal = training.calibrated(df.withColumn("raw", F.col("p")), training.fit_calibrator(df))
    pts = sorted((r["raw"], r["p"]) for r in cal.distinct().collect())
    assert all(a[1] <= b[1] for a, b in zip(pts, pts[1:])) and all(0 <= p <= 1 for _, p in pts)


def test_fits_share_one_table(table, spark, monkeypatch):
    """Each fold's learning rows are those of a fit by itself; vectors are joined, and rows written, once for all fits."""
    s = training.Settings(folds=3, step=0.3, patience=2, rounds=2, seed=1)
    vectors = table.select("row_id", F.array(F.col("number").cast("float"), F.lit(0.5).cast("float")).alias("embedding"))
    written, joined, fits = [], [], {}
    monkeypatch.setattr(training, "stage", lambda df, label, f=training.stage: written.append(label) or f(df, label))
    monkeypatch.setattr(training, "align", lambda *a, f=training.align: joined.append(1) or f(*a))
    monkeypatch.setattr(training, "_fit", lambda ready, kind, s, f=training._fit: fits.update(ready) or f(ready, kind, s))
    train = table.withColumn("y", features.within("days_to_close", s.horizon))
    oof, _ = training.oof_predictions(train, s, vectors)
    assert written.count("learning") == 1 and len(joined) == 1 and oof.count() == 1200
    folded = splits.with_time_folds(train, 3)
    weight = priors.class_weight(train, "y").first()["scale_pos_weight"]
    for fold, (ready, held) in fits.items():
        own = splits.train_part(folded, fold)
        fitted, fill = priors.fit_rate_priors(own, "y"), priors.ttf_fill(own).first()["ttf_fill"]
        both = own.withColumn("part", F.lit("train")).unionByName(splits.test_part(folded, fold).withColumn("part", F.lit("test")))
        tab = features.tabular_features(both, fitted, fill, keep=("row_id", "part"))
        names = [c for c in tab.columns if c not in ("row_id", "part")]
        rows = tab.join(vectors, "row_id").select(
            "row_id", "part", F.concat(F.array(*names), F.col("embedding").cast("array<double>")).alias("f")
        )
        want = {r["row_id"]: (r["part"], [round(v, 9) for v in r["f"]]) for r in rows.collect()}
        got = {r["row_id"]: (r["part"], [round(v, 9) for v in r["features"]]) for r in ready.collect()}
        assert held == "test" and got == want
        assert {(r["y"], r["weight"]) for r in ready.collect()} == {(0, 1.0), (1, weight)}


def test_a_null_among_the_features_stops_the_job(spark):
    df = spark.createDataFrame([(1.0, [0.5]), (None, [0.5])], "labels_count double, v array<float>")
    assert training.in_one_array(df.where("labels_count = 1"), ["labels_count"], "v").first()["features"] == [1.0, 0.5]
    with pytest.raises(Exception, match="null or NaN"):
        training.in_one_array(df, ["labels_count"], "v").collect()


def test_requests_with_lengths_score_as_with_texts(spark):
    rows = [("a", "one", "two words"), ("b", "", None), ("c", None, "")]
    base = spark.createDataFrame(rows, "row_id string, title string, body string").withColumns(
        {c: F.lit(None).cast("string") for c in ("created_at", "first_comment_at", "comments", "num_assignees")}
    ).withColumn("labels", F.array(F.lit("x")))
    size = lambda c: F.char_length(F.coalesce(c, F.lit("")))
    short = base.select("*", size("title").alias("title_len"), size("body").alias("body_len")).drop("title", "body")
    wanted = ["row_id", "title_len", "body_len", "has_body"]
    of = lambda df: sorted(map(tuple, features.serving_rows(df).select(*wanted).collect()))
    assert of(short) == of(base) == [("a", 3, 9, 1), ("b", 0, 0, 0), ("c", 0, 0, 0)]
