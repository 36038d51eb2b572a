"""Extendible hashing: shards fit, only large buckets split, rows stay whole."""

import hashlib
from collections import Counter

from issuelab.llm import sharding

from .awkward import awkward_docs, empty_docs, with_clashes


def plain(rows, limit):
    """Shard of each id by splitting buckets one by one; ids whose bucket can't be split are left out."""
    bits = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _ in rows}
    out, todo = {}, [("", rows)]
    while todo:
        prefix, own = todo.pop()
        if sum(size for _, size in own) <= limit:
            out.update((i, "s" + prefix) for i, _ in own)
        elif len(prefix) < 60:
            for b in "01":
                part = [r for r in own if bits[r[0]][len(prefix)] == b]
                if part:
                    todo.append((prefix + b, part))
    return out


def test_shards(spark):
    rows = [(i, "x" * (i % 37)) for i in range(3000)] + [(77, "y" * 900)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.assign(df, "doc_id", "text", 1000).collect()
    want = plain([(i, len(t)) for i, t in rows], 1000)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert all(r["shard"] == want[r["doc_id"]] for r in got if r["doc_id"] in want)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += len(r["text"])
    assert max(sizes.values()) <= 1000
    assert all(r["shard_bytes"] == sizes[r["shard"]] for r in got)


def test_one_key_over_the_limit_is_dealt_in_parts(spark):
    rows = [(5, "z" * 40)] * 500 + [(i, "a") for i in range(50)] + [(6, "w" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.assign(df, "doc_id", "text", 400).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += len(r["text"])
    assert all(n <= 400 for s, n in sizes.items() if n != 5000)
    assert len([s for s in sizes if "-" in s]) >= 50


def test_write_and_awkward_tables(spark, tmp_path):
    docs = with_clashes(awkward_docs(spark))
    got = sharding.assign(docs, "doc_id", "text", 1000)
    assert got.count() == docs.count()
    sharding.write_shards(got, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()
    assert sharding.assign(empty_docs(spark), "doc_id", "text", 10).count() == 0
