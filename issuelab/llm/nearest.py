"""Approximate nearest neighbours by multi-index hashing, for the largest inner product.

A rotation learned on a sample (principal axes, then iterative quantisation) turns a vector into a binary
code of up to 64 bits, cut into substrings of 16. Two codes within Hamming radius r differ by at most
floor(r / m) bits in one of the m substrings, so probing each substring's table for all values that close
finds every code within r. Codes found are checked against r in full and their vectors reranked by the
exact inner product. The radius is the one that keeps ``recall`` of the true neighbours in the sample;
in a larger table neighbours lie closer, so it errs to the safe side.

On a cluster the table is dealt into blocks of bounded size by a hash of the row, queries likewise; every
query block meets every table block once, each task indexes its block and keeps the ``k`` best per query,
and these few rows are merged. A query that found fewer than ``k`` rows within the radius, over all blocks,
is searched again with the radius of all bits, which is exact. All rows are indexed; only the rotation and radius come from the sample of
``sample_rows`` rows, chosen by a hash.

Defined results: vectors that are null, zero, of another length than most of the sample, or hold null or
non-finite components take no part. Rows equal in id and vector count once. Rows with the query's own id
are never its neighbours; a null id is no query and no neighbour. Ties go to the smaller id. Other columns
are ignored. Without vectors the result is empty.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelab.session import stage

WORD = 16
MAX_BITS = 64


@dataclass(frozen=True)
class Settings:
    k: int = 20
    sample_rows: int = 4096
    recall: float = 0.97
    rounds: int = 30
    table_block: int = 16_384
    query_block: int = 4_096
    seed: int = 11


@dataclass(frozen=True)
class Index:
    """What is learned: ``center`` and ``rotation`` of the codes, and the radius searched."""

    center: np.ndarray
    rotation: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.center) @ self.rotation > 0
        padded = np.zeros((len(vectors), MAX_BITS), np.uint8)
        padded[:, : self.bits] = signs
        return np.packbits(padded, axis=1).view(np.uint64).ravel()


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def learn(sample: np.ndarray, s: Settings) -> Index:
    """Rotation by iterative quantisation, and the radius that keeps ``recall`` within the sample."""
    center = sample.mean(axis=0)
    shifted = sample - center
    axes = np.linalg.svd(shifted, full_matrices=False)[2][:MAX_BITS].T
    flat = shifted @ axes
    turn = np.linalg.qr(np.random.default_rng(s.seed).normal(size=(flat.shape[1],) * 2))[0]
    for _ in range(s.rounds):
        u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (u @ v).T
    index = Index(center, axes @ turn, MAX_BITS)
    codes = index.codes(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 256))
    distances = []
    for i in asked:
        score = sample @ sample[i]
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(s.k, len(sample) - 1)]
        distances.append(np.bitwise_count(codes[best] ^ codes[i]))
    all_ = np.concatenate(distances) if distances else np.zeros(0)
    radius = int(np.quantile(all_, s.recall, method="higher")) if len(all_) else MAX_BITS
    return Index(center, axes @ turn, radius)


class Block:
    """Substring tables over the codes of some rows: for each substring, rows ordered by its value."""

    def __init__(self, index: Index, ids: np.ndarray, vectors: np.ndarray):
        self.index, self.ids, self.vectors = index, ids, vectors
        self.codes = index.codes(vectors)
        self.words = -(-index.bits // WORD)
        self.tables = []
        for column in self.codes.view(np.uint16).reshape(-1, 4)[:, : self.words].T:
            order = np.argsort(column, kind="stable")
            values, first = np.unique(column[order], return_index=True)
            self.tables.append((order, values, np.append(first, len(order))))

    def within_radius(self, code: np.uint64) -> np.ndarray:
        """Rows whose codes lie within the radius: union of the probed buckets, then the whole code."""
        reach = self.index.radius // self.words
        hit = np.zeros(len(self.ids), bool)
        parts = np.array([code]).view(np.uint16)
        for (order, values, first), part in zip(self.tables, parts):
            near = np.bitwise_count(values ^ part) <= reach
            # Buckets lie one after the other in ``order``; spread the choice of buckets over their rows.
            hit[order[np.repeat(near, np.diff(first))]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= self.index.radius]

    def search(self, query_id: int, vector: np.ndarray, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = self.within_radius(code)
        rows = rows[self.ids[rows] != query_id]
        scores = self.vectors[rows] @ vector
        if len(rows) > k:
            floor = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= floor
            rows, scores = rows[keep], scores[keep]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), np.float64).reshape(-1, size)


def _searched(table: DataFrame, blocks: int, asked: DataFrame, index: Index, size: int, s: Settings) -> DataFrame:
    """The ``k`` best rows of each block of ``table`` within the radius of each query: query_id, spread, vec_id, score."""
    query_blocks = max(1, -(-asked.count() // s.query_block))

    def deal(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod("spread", F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        own: list[np.ndarray] = []
        ids, ranks, scores = [], [], []
        if left.num_rows and right.num_rows:
            block = Block(index, np.asarray(left["vec_id"]), _matrix(left["embedding"], size))
            asked_vectors = _matrix(right["embedding"], size)
            codes = index.codes(asked_vectors)
            marks = zip(np.asarray(right["vec_id"]), asked_vectors, codes, np.asarray(right["spread"]))
            for query_id, vector, code, mark in marks:
                found, score = block.search(query_id, vector, code, s.k)
                own.append(np.full(len(found), query_id))
                ids.append(found)
                scores.append(score)
                ranks.append(np.full(len(found), mark))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table(
            {
                "query_id": join(own, np.int64),
                "spread": join(ranks, np.int64),
                "vec_id": join(ids, np.int64),
                "score": join(scores, np.float64),
            }
        )

    left = deal(table, "t", blocks, "q", query_blocks).groupBy("q", "t")
    right = deal(asked, "q", query_blocks, "t", blocks).groupBy("q", "t")
    kind = "query_id bigint, spread bigint, vec_id bigint, score double"
    return left.cogroup(right).applyInArrow(meet, kind)


def nearest(vectors: DataFrame, queries: DataFrame, s: Settings = Settings()) -> DataFrame:
    """For each row of ``queries`` its ``k`` best rows of ``vectors``: query_id, rank, vec_id, score.

    Both have ``vec_id`` and ``embedding``. A query has ``k`` rows, or all there are if they are fewer.
    """
    spark = vectors.sparkSession
    clean = lambda df: (
        df.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
        .where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .distinct()
        .withColumn("spread", F.xxhash64("vec_id", "embedding"))
    )
    table, asked = clean(vectors), clean(queries)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    sample = [r[0] for r in table.orderBy("spread", "vec_id").limit(s.sample_rows).select("embedding").collect()]
    if not sample:
        return spark.createDataFrame([], result)
    lengths, counts = np.unique([len(v) for v in sample], return_counts=True)
    size = int(lengths[counts.argmax()])
    index = learn(np.array([v for v in sample if len(v) == size]), s)
    table, asked = (df.where(F.size("embedding") == size) for df in (table, asked))
    blocks = -(-table.count() // s.table_block)
    found = stage(_searched(table, blocks, asked, index, size, s), "found")
    counts = found.groupBy("query_id", "spread").agg(F.count("*").alias("c")).where(F.col("c") >= s.k)
    enough = counts.select(F.col("query_id").alias("vec_id"), "spread")
    short = stage(asked.join(enough, ["vec_id", "spread"], "left_anti").select(*asked.columns), "short")
    if index.radius < MAX_BITS and not short.isEmpty():
        again = _searched(table, blocks, short, replace(index, radius=MAX_BITS), size, s)
        found = found.join(enough.withColumnRenamed("vec_id", "query_id"), ["query_id", "spread"], "left_semi")
        found = found.unionByName(again)
    best = Window.partitionBy("query_id", "spread").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
