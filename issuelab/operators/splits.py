"""Time-ordered splits.

Only the order keys are sorted; the rows at the cut positions become literals, and every row is
assigned by comparing its key with them. No wide row moves, and a split's filter reaches the scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.operators.ordering import before_key, keys_at_positions

ORDER = ("created_ts", "row_id")
MIN_OOF_ROWS = 200


def split_sizes(n: int, train: float = 0.8, dev: float = 0.1, test: float = 0.1) -> tuple[int, int]:
    if not math.isclose(train + dev + test, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError("train, dev and test must sum to 1")
    return int(n * train), int(n * dev)


def time_split_column(
    df: DataFrame,
    train: float = 0.8,
    dev: float = 0.1,
    test: float = 0.1,
    order: Sequence[str] = ORDER,
) -> Column:
    """``train`` / ``dev`` / ``test`` by position in time; ties go by the last order key."""
    cuts = lambda n: [sum(split_sizes(n, train, dev, test)[:i]) for i in (1, 2)]
    n, keys = keys_at_positions(df, order, cuts)
    first, second = cuts(n)
    # A cut at the very end has no key: everything lies before it.
    before = lambda at: before_key(order, keys[at]) if at in keys else F.lit(at >= n)
    return F.when(before(first), "train").when(before(second), "dev").otherwise("test")


def with_time_split(df: DataFrame, **kwargs) -> DataFrame:
    return df.withColumn("split", time_split_column(df, **kwargs))


def fold_starts(n: int, k: int) -> list[int]:
    """Start of each test block: k blocks of n // (k + 1) rows at the end."""
    size = n // (k + 1)
    if size < 1:
        raise ValueError(f"{n} rows are too few for {k} folds")
    return [n - (k - i) * size for i in range(k)]


def time_fold_column(df: DataFrame, k: int = 5, order: Sequence[str] = ORDER) -> Column:
    """The test block a row falls in, null for the first (train-only) block."""
    n, keys = keys_at_positions(df, order, lambda n: fold_starts(n, k))
    fold = F.lit(None).cast("int")
    for i, start in enumerate(fold_starts(n, k)):
        fold = F.when(~before_key(order, keys[start]), i).otherwise(fold)
    return fold


def with_time_folds(df: DataFrame, k: int = 5, order: Sequence[str] = ORDER) -> DataFrame:
    """Add ``fold`` (:func:`time_fold_column`). Fold i trains on every row with a smaller or null fold."""
    return df.withColumn("fold", time_fold_column(df, k, order))


def train_part(folded: DataFrame, fold: int) -> DataFrame:
    return folded.where(F.col("fold").isNull() | (F.col("fold") < fold))


def test_part(folded: DataFrame, fold: int) -> DataFrame:
    return folded.where(F.col("fold") == fold)


def oof_coverage(df: DataFrame, prediction: str) -> DataFrame:
    """Rows, rows with an out-of-fold prediction and their share."""
    has = F.col(prediction).isNotNull()
    return df.agg(
        F.count("*").alias("n"),
        F.count(prediction).alias("valid"),
        F.avg(has.cast("double")).alias("coverage"),
    )


def require_oof(valid: int, coverage: float) -> None:
    if valid < MIN_OOF_ROWS:
        raise ValueError(
            f"too few out-of-fold predictions for a stable threshold: {valid} (coverage {coverage:.3f})"
        )
