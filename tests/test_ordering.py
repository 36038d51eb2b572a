"""Distributed order statistics against brute force, with one group holding most rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from issuelab.operators import lookup, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(4000):
        group = "hot" if rng.random() < 0.6 else f"g{rng.randrange(40)}"
        value = float(rng.randrange(50)) if rng.random() < 0.9 else None
        data.append((i, group, value))
    return data, spark.createDataFrame(data, "id long, grp string, v double").repartition(16)


def test_grouped_median_is_exact_under_skew(skewed):
    data, df = skewed
    want = {}
    for _, g, v in data:
        if v is not None:
            want.setdefault(g, []).append(v)
    got = {r["grp"]: (r["n"], r["median"]) for r in ordering.exact_median(df, "v", ["grp"]).collect()}
    assert got == {g: (len(vs), statistics.median(vs)) for g, vs in want.items()}


def test_global_median_and_empty_input(skewed, spark):
    data, df = skewed
    row = ordering.exact_median(df, "v").first()
    assert row["median"] == statistics.median([v for *_, v in data if v is not None])
    empty = ordering.exact_median(df.where("id < 0"), "v").first()
    assert empty["median"] is None


def test_median_with_null_group_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["median"] for r in ordering.exact_median(df, "v", ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_running_totals_match_a_window(skewed):
    data, df = skewed
    rows = df.select("grp", "id", F.lit(2).cast("long").alias("w"))
    got = {
        r["id"]: (r["w_before"], r["w_all"])
        for r in ordering.running_totals(rows, ["id"], ["w"], ["grp"]).collect()
    }
    seen, size = {}, {}
    for i, g, _ in sorted(data):
        size[g] = size.get(g, 0) + 2
    for i, g, _ in sorted(data):
        assert got[i] == (seen.get(g, 0), size[g])
        seen[g] = seen.get(g, 0) + 2


def test_a_hot_group_is_split_over_tasks(skewed, monkeypatch):
    _, df = skewed
    sizes = []

    def spy(table, label):
        out = stage(table, label)
        if "_part" in out.columns:
            sizes.extend(r["count"] for r in out.groupBy("_part").count().collect())
        return out

    stage = ordering.stage
    monkeypatch.setattr(ordering, "stage", spy)
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordering.row_positions(df.select("grp", "id"), ["id"], ["grp"]).count()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 4000 * 0.25


def test_global_positions(skewed):
    data, df = skewed
    got = ordering.row_positions(df.select("id"), ["id"]).collect()
    assert all(r["pos"] == r["id"] and r["group_rows"] == len(data) for r in got)


def test_keys_at_positions(skewed):
    _, df = skewed
    n, keys = ordering.keys_at_positions(df, ["id"], lambda n: [0, n // 2, n - 1, n, -1])
    assert n == 4000 and keys == {0: (0,), 2000: (2000,), 3999: (3999,)}


def test_approx_median_is_close(skewed):
    _, df = skewed
    exact = ordering.exact_median(df, "v").first()["median"]
    assert abs(ordering.approx_median(df, "v").first()["median"] - exact) <= 1


def test_lookup_join_paths_agree(skewed, spark):
    """Broadcast, hot-key split and plain join give the same rows; null and unseen keys get null."""
    _, df = skewed
    facts = df.select("id", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("grp")).alias("grp"))
    table = (
        df.groupBy("grp").agg(F.count("*").alias("cnt"), F.max("id").alias("top")).where("grp <> 'g3'")
    )
    small = sorted(lookup.lookup_join(facts, table, "grp", "cnt").collect(), key=lambda r: r["id"])
    for weight in ("cnt", None):
        large = lookup.lookup_join(facts, table, "grp", weight, broadcast_rows=2)
        assert large.columns == ["id", "grp", "cnt", "top"]
        assert sorted(large.collect(), key=lambda r: r["id"]) == small


def test_hot_keys_are_spread(skewed, monkeypatch):
    """Beyond the broadcast bound the heaviest keys do not gather in one shuffle partition."""
    _, df = skewed
    monkeypatch.setattr(lookup, "HOT_KEYS", 1)
    table = df.groupBy("grp").agg(F.count("*").alias("cnt"))
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.lookup_join(df, table, "grp", "cnt", ["id"], broadcast_rows=2)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 4000 * 0.3


def test_nested_columns_count_towards_the_broadcast_size(spark, monkeypatch):
    table = spark.range(50).select("id", F.expr("sequence(1, 1000)").alias("steps"), F.expr("map('k', id)").alias("m"))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 50 * 1000 * 3)
    assert lookup.fits_broadcast(table.select("id", "m"), 50) and not lookup.fits_broadcast(table.select("id", "m"), 49)
    assert lookup.fits_broadcast(table.select("id"), 50) and not lookup.fits_broadcast(table, 50)


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_columns_named_like_helpers_are_kept(spark, rows):
    facts = spark.range(300).select(
        (F.col("id") % 7).cast("string").alias("grp"), *[F.col("id").alias(c) for c in ("_join", "_hot", "_HOT_VALUES", "_cold", "x")]
    )
    table = spark.range(5).select(
        F.col("id").cast("string").alias("grp"), (F.col("id") * 10).alias("_k"), F.col("id").alias("_cold_values"), F.lit(1).alias("n")
    )
    got = lookup.lookup_join(facts, table, "grp", weight="n", spread_by=["x"], broadcast_rows=rows)
    assert got.columns == [*facts.columns, "_k", "_cold_values", "n"]
    for r in got.collect():
        own = int(r["grp"])
        assert r["_join"] == r["_hot"] == r["_HOT_VALUES"] == r["_cold"] == r["x"] and r["x"] % 7 == own
        assert (r["_k"], r["_cold_values"]) == ((own * 10, own) if own < 5 else (None, None))
