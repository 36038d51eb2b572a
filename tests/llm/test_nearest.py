"""Multi-index hashing: the probes against all codes, the search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from issuelab.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, rank string"


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(3000, 48))
    index = nearest.learn(vectors[:800], nearest.Settings())
    for radius in (3, 9, 17):
        near = nearest.Index(index.center, index.rotation, radius)
        block = nearest.Block(near, np.arange(3000), vectors)
        for q in range(0, 3000, 300):
            want = np.flatnonzero(np.bitwise_count(block.codes ^ block.codes[q]) <= radius)
            assert np.array_equal(block.within_radius(block.codes[q]), want)


def brute(vectors, ids, query, k):
    score = vectors @ vectors[query]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]][:k]
    return ids[order]


def test_recall(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    got = nearest.nearest(table, table.where(F.col("vec_id") % 20 == 0)).toPandas()
    rows = table.toPandas()
    vectors, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        own = got[got["query_id"] == ids[q]].sort_values("rank")
        want = brute(vectors, ids, q, 20)
        hit, total = hit + len(set(want) & set(own["vec_id"])), total + len(want)
        np.testing.assert_allclose(own["score"], [vectors[ids == v][0] @ vectors[q] for v in own["vec_id"]])
        assert list(own["rank"]) == list(range(1, len(own) + 1)) and (np.diff(own["score"]) <= 0).all()
    assert hit >= 0.9 * total


def test_blocks_do_not_change_the_result(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    asked = table.where(F.col("vec_id") % 20 == 0)
    small = nearest.Settings(table_block=60, query_block=7)
    order = lambda df: df.orderBy("query_id", "rank").select("query_id", "rank", "vec_id").collect()
    assert order(nearest.nearest(table, asked, small)) == order(nearest.nearest(table, asked))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.1]), (40, [0.0, 1.0])]
    rows += [(4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA)
    asked = df.where("vec_id % 20 = 0")
    got = nearest.nearest(df, asked, nearest.Settings(recall=1.0)).collect()
    of = lambda q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
    assert of(20)[:2] == [1, 2] and set(of(20)) <= {1, 2, 3, 40} and set(of(40)) <= {20, 1, 2, 3}
    assert nearest.nearest(df.where("false"), asked.where("false")).count() == 0
    alone = df.where("vec_id = 40")
    assert nearest.nearest(alone, alone).count() == 0


def test_every_query_gets_its_rows_with_the_settings_of_the_query(spark):
    rng = np.random.default_rng(3)
    alike = np.ones(16) + rng.normal(0, 0.01, (400, 16))  # most rows are alike, few lie elsewhere
    rows = np.concatenate([alike, rng.normal(size=(60, 16)) - 1])
    for vectors in (rows, rng.normal(size=(15, 16))):
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        for s in (nearest.Settings(), nearest.Settings(table_block=50, query_block=9)):
            got = nearest.nearest(df, df.where("vec_id % 5 = 0"), s).toPandas().groupby("query_id").size()
            want = min(20, len(vectors) - 1)
            assert list(got.index) == list(range(0, len(vectors), 5)) and (got == want).all()
