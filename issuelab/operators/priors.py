"""Statistics fitted on training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.operators.features import RepoPriors
from issuelab.operators.ordering import approx_median, exact_median
from issuelab.session import stage

REPO = "repo_full_name"


def rate_table(train: DataFrame, label: str) -> DataFrame:
    """Rows and positive rate per repository."""
    return train.groupBy(REPO).agg(
        F.count("*").alias("cnt"), F.avg(F.col(label).cast("double")).alias("posrate")
    )


def median_table(train: DataFrame, target: str, approx: bool = False) -> DataFrame:
    """Rows and median target per repository (the target has no nulls here)."""
    median = approx_median if approx else exact_median
    return median(train, target, [REPO]).select(
        REPO, F.col("n").alias("cnt"), F.col("median").alias("median_days")
    )


def rate_globals(table: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Fallbacks from the per-repository table: mean rows per repository and overall rate."""
    return table.groupBy(*by).agg(
        F.coalesce(F.avg("cnt"), F.lit(1.0)).alias("global_count"),
        (F.sum(F.col("posrate") * F.col("cnt")) / F.sum("cnt")).alias("global_posrate"),
    )


def median_globals(table: DataFrame, train: DataFrame, target: str, approx: bool = False) -> DataFrame:
    median = approx_median if approx else exact_median
    counts = table.agg(F.coalesce(F.avg("cnt"), F.lit(1.0)).alias("global_count"))
    return counts.crossJoin(  # one row each
        median(train, target).select(F.col("median").alias("global_median"))
    )


def fit_rate_priors(train: DataFrame, label: str) -> RepoPriors:
    table = stage(rate_table(train, label), "rates")
    g = rate_globals(table).first()
    return RepoPriors(table, "posrate", g["global_count"], g["global_posrate"] or 0.0)


def fit_median_priors(train: DataFrame, target: str, approx: bool = False) -> RepoPriors:
    table = stage(median_table(train, target, approx), "medians")
    g = median_globals(table, train, target, approx).first()
    return RepoPriors(table, "median_days", g["global_count"], g["global_median"] or 0.0)


def ttf_fill(train: DataFrame, column: str = "ttf_hours") -> DataFrame:
    """Median hours to the first answer, 0 when no row has one."""
    return exact_median(train, column).select(F.coalesce("median", F.lit(0.0)).alias("ttf_fill"))


def class_weight(train: DataFrame, label: str) -> DataFrame:
    """Class counts and the weight of a positive row."""
    y = F.col(label)
    counts = train.agg(
        F.coalesce(F.sum((y == 1).cast("long")), F.lit(0)).alias("pos"),
        F.coalesce(F.sum((y == 0).cast("long")), F.lit(0)).alias("neg"),
    )
    one = F.lit(1)
    weight = F.greatest("neg", one) / F.greatest("pos", one)
    return counts.withColumn("scale_pos_weight", weight)


def later_folds(k: int) -> Column:
    """Folds whose training part holds a row: those after the row's own block (null = first block)."""
    own = F.coalesce("fold", F.lit(-1))
    return F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f > own)


def fold_rate_tables(folded: DataFrame, label: str, k: int) -> DataFrame:
    """Rate priors of every fold in one pass: aggregate per block, then add up earlier blocks."""
    blocks = folded.groupBy(REPO, "fold").agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    spread = blocks.select(REPO, "n", "pos", F.explode(later_folds(k)).alias("for_fold"))
    return spread.groupBy("for_fold", REPO).agg(
        F.sum("n").alias("cnt"), (F.sum("pos") / F.sum("n")).alias("posrate")
    )


def fold_medians(folded: DataFrame, value: str, k: int) -> DataFrame:
    """Median of ``value`` in every fold's training part, nulls ignored; a fold without values has no row."""
    values = folded.where(F.col(value).isNotNull()).groupBy("fold", value).agg(F.count("*").alias("n"))
    spread = values.select(value, "n", F.explode(later_folds(k)).alias("for_fold"))
    return exact_median(spread, value, ["for_fold"], weight="n").select("for_fold", "median")


def fold_median_tables(folded: DataFrame, target: str, k: int) -> DataFrame:
    """Median priors of every fold; values collapse to counts before they are copied per fold."""
    values = folded.groupBy(REPO, "fold", target).agg(F.count("*").alias("n"))
    spread = values.select(REPO, target, "n", F.explode(later_folds(k)).alias("for_fold"))
    return exact_median(spread, target, ["for_fold", REPO], weight="n").select(
        "for_fold", REPO, F.col("n").alias("cnt"), F.col("median").alias("median_days")
    )
