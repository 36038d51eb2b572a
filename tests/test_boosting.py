"""Boosting: trees equal a plain loop's, a carried-on fit equals a long one, leaf-wise growth, patience, files."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from issuelab.operators import boosting
from issuelab.operators.boosting import Boosting

SCHEMA = "fit int, held boolean, row_id string, label double, weight double, x array<double>"


def made(n=400, seed=3, fits=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.randrange(12) / 4, rng.random(), float(i % 3), 1.0]
        y = float(x[0] + 0.3 * rng.gauss(0, 1) > 1.4 or x[2] == 2 and x[1] > 0.5)
        for fit in range(fits):
            rows.append((fit, i % 5 == fit % 5, f"r{i}", y, 1.0 + i % 2, x))
    return rows


def frame(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.withColumn("features", array_to_vector("x")).drop("x")


def plain(rows, s, rounds, edges):
    """Every row and feature in each tree; splits by trying all cuts."""
    train = [r for r in rows if not r[1]]
    x, y, w = (np.array([r[k] for r in train]) for k in (5, 3, 4))
    mean = round((y * w).sum() / w.sum(), 12)
    base = round(math.log(mean / (1 - mean)), 12) if s.objective == "logistic" else mean
    margin = np.full(len(x), base)
    for _ in range(rounds):
        if s.objective == "logistic":
            p = 1 / (1 + np.exp(-margin))
            g, h = w * (p - y), w * p * (1 - p)
        else:
            g, h = w * (margin - y) / np.sqrt(1 + (margin - y) ** 2), w * (1 + (margin - y) ** 2) ** -1.5
        score = lambda of: g[of].sum() ** 2 / (h[of].sum() + s.l2)
        leaves, out = [(np.ones(len(x), bool), 0)], []
        while leaves:
            of, level = leaves.pop()
            best = None
            for j, cuts in enumerate(edges if level < s.depth else []):
                for cut in cuts:
                    left, right = of & (x[:, j] <= cut), of & (x[:, j] > cut)
                    if min(h[left].sum(), h[right].sum()) >= s.min_child_weight:
                        gain = score(left) + score(right) - score(of)
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                            best = gain, left, right
            if best:
                leaves += [(best[1], level + 1), (best[2], level + 1)]
            else:
                out.append(of)
        step = np.zeros(len(x))
        for of in out:
            step[of] = -s.step * g[of].sum() / (h[of].sum() + s.l2)
        margin += step
    return {r[2]: m for r, m in zip(train, margin)}


def trained(spark, df, s, rounds):
    return boosting.grow(spark, boosting.start(df, s), rounds)


@pytest.mark.parametrize("objective", ["logistic", "pseudo_huber"])
def test_margins_equal_a_plain_loop(spark, objective):
    s = Boosting(objective, depth=3, step=0.3, l2=2.0, min_child_weight=4.0, subsample=1.0, columns=1.0, bins=16, patience=50)
    rows = made()
    fits = trained(spark, frame(spark, rows), s, 4)
    want = plain(rows, s, 4, fits.edges[0])
    model = fits.models[0]
    x = np.array([r[5] for r in rows if not r[1]])
    got = model.base + sum(boosting._leaf_values(t, x, t.cut) for t in model.trees)
    ids = [r[2] for r in rows if not r[1]]
    assert max(abs(a - want[i]) for a, i in zip(got, ids)) < 1e-4
    scored = {r["row_id"]: r["prediction"] for r in model.transform(frame(spark, rows)).collect()}
    link = (lambda m: 1 / (1 + math.exp(-m))) if objective == "logistic" else (lambda m: m)
    assert max(abs(scored[i] - link(m)) for i, m in zip(ids, got)) < 1e-9


def test_a_fit_carried_on_equals_one_long_fit(spark, monkeypatch):
    s = Boosting(step=0.2, min_child_weight=1.0, patience=50, bins=16)
    rows = made(fits=2)
    long = trained(spark, frame(spark, rows, 5), s, 7)
    monkeypatch.setattr(boosting, "MARK", 2)
    short = trained(spark, frame(spark, rows, 3), s, 3)  # other partitions, margins written in between
    short = boosting.grow(spark, boosting.mark(spark, short), 4)
    assert short.models == long.models and short.losses == long.losses
    assert short.marked > 3 and long.marked == 0


def test_losses_are_those_of_the_held_out_rows(spark):
    s = Boosting(step=0.3, min_child_weight=1.0, rounds=5, patience=10, bins=16)
    df = frame(spark, made())
    model, losses = boosting.fit_many(df, s)[0]
    y, p = F.col("label"), F.col("prediction")
    loss = -model.transform(df.where("held")).agg(F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).first()[0]
    assert len(losses) == 5 and abs(losses[model.getNumTrees - 1] - loss) < 1e-5 and min(losses) == losses[model.getNumTrees - 1]


def test_leaves_open_by_gain(spark):
    s = Boosting(depth=4, max_leaves=3, step=0.3, l2=1.0, min_child_weight=1.0, subsample=1.0, columns=1.0, bins=16, patience=9)
    few = trained(spark, frame(spark, made()), s, 1).models[0].trees[0]
    full = trained(spark, frame(spark, made()), Boosting(**{**s.__dict__, "max_leaves": 64}), 1).models[0].trees[0]
    inner = [k for k, f in enumerate(few.feature) if f >= 0]
    assert len(inner) == 2 and inner[0] == 0 and sum(f >= 0 for f in full.feature) > 2
    assert few.value == full.value and all(few.feature[k] == full.feature[k] for k in inner)


def test_patience_ends_a_fit_and_the_best_round_stays(spark):
    rng = random.Random(1)
    rows = [(0, i % 2 == 0, f"r{i}", float(rng.random() < 0.5), 1.0, [rng.random(), rng.random()]) for i in range(200)]
    s = Boosting(step=0.5, l2=0.1, min_child_weight=0.5, patience=4, bins=16, rounds=60)
    model, losses = boosting.fit_many(frame(spark, rows), s)[0]
    assert model.getNumTrees == losses.index(min(losses)) + 1 and len(losses) == model.getNumTrees + 4
    assert boosting.best_round([5, 4, 3, 3.5, 3.2, 2.9, 3, 3, 3], 3) == (6, True)
    assert boosting.best_round([5, 4, 3, 3.5, 3.2, 3.1, 2.9], 3) == (3, True)
    assert boosting.best_round([5, 4, 3], 3) == (3, False)


def test_without_held_out_rows_and_files(spark, tmp_path):
    rows = [(0, False, *r[2:]) for r in made(100)]
    model, losses = boosting.fit_many(frame(spark, rows), Boosting(patience=2, min_child_weight=1.0, step=0.3))[0]
    assert losses == [] and model.getNumTrees == 4
    boosting.save(spark, model, str(tmp_path / "m"))
    assert boosting.load(spark, str(tmp_path / "m")) == model
    with pytest.raises(ValueError, match="bins"):
        boosting.start(frame(spark, rows), Boosting(bins=300))


def test_rows_are_kept_in_blocks(spark, monkeypatch):
    """A pass reads one row of the written table for many rows; small blocks and batches give the same trees."""
    df = frame(spark, made(fits=2)).cache()
    s = Boosting(min_child_weight=1.0, patience=5, step=0.3)
    fits = boosting.grow(spark, boosting.start(df, s), 3)
    written = spark.read.parquet(fits.rows)
    assert written.agg(F.sum("size")).first()[0] == df.count() == 800
    assert written.count() <= 2 * df.rdd.getNumPartitions()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 7)
    monkeypatch.setattr(boosting, "BATCH_BYTES", 500)
    small = boosting.mark(spark, boosting.grow(spark, boosting.start(df, s), 2))
    assert spark.read.parquet(small.rows).count() >= 800 / 7
    assert boosting.grow(spark, small, 1).models == fits.models


def test_edges_lie_at_equal_steps_of_rank(spark, monkeypatch):
    """Exact for few rows; within the bound where values of many rows are thinned out, whatever the partitions."""
    s = Boosting(bins=16)
    rng = random.Random(4)
    x = [[rng.gauss(0, 1), float(i % 3)] for i in range(1000)]
    df = spark.createDataFrame([(0, v) for v in x], "fit int, v array<double>").repartition(7)
    by_rank = lambda j, k: sorted(v[j] for v in x)[math.ceil(k / 16 * 1000) - 1]
    want = [sorted({by_rank(j, k) for k in range(1, 16)}) for j in (0, 1)]
    assert boosting._edges(df, s) == {0: want}
    monkeypatch.setattr(boosting, "POINTS", 25)
    monkeypatch.setattr(boosting, "RANKED_ROWS", 90)
    near = boosting._edges(df, s)[0]
    ranks = [sum(v[0] <= cut for v in x) for cut in near[0]]
    assert near[1] == [0.0, 1.0, 2.0] and all(abs(r - 1000 * k / 16) <= 1000 / 50 + 7 for k, r in enumerate(ranks, 1))


def test_plain_arrays_are_features_too(spark):
    df = spark.createDataFrame(made(), SCHEMA).repartition(3)
    s = Boosting(min_child_weight=1.0, patience=5, step=0.3, rounds=3)
    plain_rows = df.withColumnRenamed("x", "features")
    (model, losses), (other, same) = boosting.fit_many(plain_rows, s)[0], boosting.fit_many(frame(spark, made()), s)[0]
    assert model == other and losses == same
    with pytest.raises(Exception, match="null among the features"):
        model.transform(plain_rows.withColumn("features", F.array(F.lit(None).cast("double")))).collect()
