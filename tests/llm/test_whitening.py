"""Whitening: equal to a plain eigen-decomposition; exact sums; awkward vectors."""

import math
from fractions import Fraction

import numpy as np

from issuelab.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], schema).repartition(3)


def plain(x):
    """Covariance and deviations of the distinct rows of whole numbers, in exact arithmetic."""
    fit = sorted({tuple(map(int, r)) for r in x})
    n, d = len(fit), len(fit[0])
    s = [sum(r[i] for r in fit) for i in range(d)]
    centred = [[n * r[i] - s[i] for i in range(d)] for r in fit]
    v = [[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)]
    return n, s, np.array(v)


def check(spark, vectors, components=16, schema=SCHEMA):
    df = table(spark, vectors, schema)
    model = whitening.fit(df, components)
    rows = whitening.transform(df, model).collect()
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, s, v = plain(x)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes.T[::-1]
    assert model.n == n and model.sums == s
    assert np.allclose(model.eigenvalues, values[:components], rtol=1e-9, atol=1e-12 * values[0])
    for r in rows:
        off = [n * c - t for c, t in zip(x[r["vec_id"]], s)]
        assert int(r["deviation"]) == sum(o * o for o in off) and r["n"] == n
        at = r["component"] - 1
        if at < model.kept:
            want = sum(o / n * a for o, a in zip(off, axes[at])) / math.sqrt(values[at])
            assert abs(abs(r["whitened"]) - abs(want)) < 1e-6
            assert abs(r["explained"] - values[at] / values.sum()) <= 1e-9
        else:
            assert r["whitened"] is None
    assert len(rows) == len(vectors) * min(components, len(vectors[0]))
    return model


def test_equals_plain_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 12)) * np.linspace(0.2, 2, 12)
    vectors = base.astype("float32").tolist()
    vectors += [vectors[0]] * 150  # a third of all rows are copies: they weigh nothing
    model = check(spark, vectors)
    assert model.kept == 12 and model.identity_error < 1e-9


def test_large_offsets_and_numbers_stay_exact(spark):
    rng = np.random.default_rng(4)
    wide = (rng.normal(size=(60, 5)) * 1e9 + 1e12).tolist()
    check(spark, wide, 3, "vec_id bigint, embedding array<double>, label int")


def test_dimensions_without_spread(spark):
    vectors = [[float(i % 5), 2.0, float(i % 5) * 2] for i in range(20)]
    model = check(spark, vectors)
    assert model.kept == 1 and model.identity_error < 1e-9


def test_awkward_vectors(spark):
    good = [[float(i), float(i * i % 7), 1.0 - i] for i in range(8)]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = [(i, v, "mine", 5) for i, v in enumerate(good + bad)] + [(None, good[0], "mine", 5), (0, good[0], "mine", 5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, x string, component int")
    model = whitening.fit(df)
    got = whitening.transform(df, model)
    assert model.n == 8 and got.count() == 10 * 3
    assert got.where("vec_id is null").count() == 3 and got.where("vec_id = 0").count() == 6
    assert got.where("vec_id > 7").count() == 0
    one = df.where("vec_id = 3")
    alone = whitening.transform(one, whitening.fit(one)).collect()
    assert [r["whitened"] for r in alone] == [None] * 3 and alone[0]["identity_error"] is None
    assert alone[0]["deviation"] == 0 and alone[0]["explained"] == 0.0
    nothing = df.where("vec_id = 8")
    assert whitening.fit(nothing) is None and whitening.transform(nothing, None).count() == 0


def test_deviation_beyond_a_long_is_null_in_the_query_form(spark):
    big = spark.sql("SELECT CAST('99999999999999999999' AS DECIMAL(38,0)) AS d UNION ALL SELECT 7")
    assert {r[0] for r in big.select(whitening.as_long(big["d"])).collect()} == {None, 7}
