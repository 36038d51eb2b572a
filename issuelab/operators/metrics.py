"""Evaluation metrics as aggregations.

Ranking metrics first collapse rows to one per distinct score; running sums over the scores are then
taken with range partitioning instead of one sorted task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.operators.ordering import exact_median, running_totals, totals_by

EPS = 1e-6


def score_table(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score, from high to low: own and cumulative positives and negatives."""
    pos = F.col(y).cast("long")
    counts = totals_by(
        df.select(pos.alias("_y"), (-F.col(p)).alias("_down"), F.col(p).alias("score")),
        {"pos": F.col("_y"), "neg": 1 - F.col("_y")},
        ["_down", "score"],
    )
    ranked = running_totals(counts, ["_down"], ["pos", "neg"])
    return ranked.select(
        "score",
        "pos",
        "neg",
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (F.col("neg_before") + F.col("neg")).alias("fp"),
        F.col("pos_all").alias("n_pos"),
        F.col("neg_all").alias("n_neg"),
    )


def pr_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Precision and recall when predicting positive from each score up."""
    t = score_table(df, y, p)
    recall = F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(1.0)
    return t.select(
        "score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), recall.alias("recall")
    )


def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """The points and the closing one: precision 1 at recall 0, without a score."""
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return pr_points(df, y, p).unionByName(end)


def roc_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """The points and the first one, above every score: both rates 0."""
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return roc_points(df, y, p).unionByName(start)


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """False and true positive rate at each score, for data with both classes."""
    t = score_table(df, y, p)
    rate = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole))
    return t.select("score", rate("fp", "n_neg").alias("fpr"), rate("tp", "n_pos").alias("tpr"))


def best_threshold(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Score with the highest F1; of equal ones the lowest. 0.5 without any score."""
    pr = pr_points(df, y, p)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-12)
    best = pr.select("score", f1.alias("f1")).agg(
        F.max_by("score", F.struct(F.col("f1"), -F.col("score"))).alias("threshold"),
        F.max("f1").alias("f1"),
    )
    return best.select(
        F.coalesce("threshold", F.lit(0.5)).alias("threshold"), F.coalesce("f1", F.lit(0.0)).alias("f1")
    )


def clipped(p: str = "p") -> Column:
    return F.greatest(F.least(F.col(p), F.lit(1 - EPS)), F.lit(EPS))


def confusion(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    pred = (clipped(p) >= threshold).cast("int")
    return df.select(F.col(y).cast("int").alias("y"), pred.alias("pred")).groupBy("y", "pred").count()


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def threshold_metrics(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and F1 at a threshold; 0 where a denominator is 0."""
    hit, truth = clipped(p) >= threshold, F.col(y) == 1
    count = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0))
    c = df.agg(
        count(hit & truth).alias("tp"), count(hit & ~truth).alias("fp"), count(~hit & truth).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def probability_losses(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Log loss and Brier score on clipped probabilities."""
    q, truth = clipped(p), F.col(y).cast("double")
    return df.agg(
        F.avg(-(truth * F.log(q) + (1 - truth) * F.log(1 - q))).alias("logloss"),
        F.avg((q - truth) * (q - truth)).alias("brier"),
    )


def _ranking(scores: DataFrame) -> DataFrame:
    neg_below = F.col("n_neg") - F.col("fp")
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    pairs = F.sum(F.col("pos") * (neg_below + F.col("neg") / 2))
    step = F.col("pos") / F.col("n_pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return scores.agg(
        F.when(both, pairs / (F.max("n_pos") * F.max("n_neg"))).alias("roc_auc"),
        F.when(both, F.sum(F.when(F.col("n_pos") > 0, step))).alias("pr_auc"),
    )


def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """ROC-AUC (ties count half) and average precision; null unless both classes occur.

    Like the other probability metrics they see clipped scores.
    """
    return _ranking(score_table(df.select(y, clipped(p).alias(p)), y, p))


def classification_metrics(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """All classifier metrics in one row."""
    return (
        probability_losses(df, y, p)
        .crossJoin(threshold_metrics(df, threshold, y, p))  # one row each
        .crossJoin(ranking_metrics(df, y, p))
    )


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Error metrics in days in one row; median absolute error is exact."""
    err = F.col(y) - F.col(pred)
    d = df.select(F.col(y).alias("y"), err.alias("err"), F.abs(err).alias("abs_err"))
    within = lambda days: F.avg((F.col("abs_err") <= days).cast("double"))
    mse, var_y, var_err = F.avg(F.col("err") * F.col("err")), F.var_pop("y"), F.var_pop("err")
    # A constant target scores 1 if it is hit exactly, else 0.
    explained = lambda lost: (
        F.when(var_y > 0, 1 - lost / var_y).when(var_y == 0, F.when(lost == 0, 1.0).otherwise(0.0))
    )
    main = d.agg(
        F.avg("abs_err").alias("mae"),
        F.sqrt(mse).alias("rmse"),
        explained(mse).alias("r2"),
        explained(var_err).alias("explained_variance"),
        within(3.0).alias("acc_within_3d"),
        within(7.0).alias("acc_within_7d"),
        within(14.0).alias("acc_within_14d"),
    )
    return main.crossJoin(exact_median(d, "abs_err").select(F.col("median").alias("median_ae")))


def median_baseline(train: DataFrame, test: DataFrame, y: str = "y") -> DataFrame:
    """Metrics of predicting the training median for every test row."""
    guess = exact_median(train, y).select(F.col("median").alias("pred"))
    return regression_metrics(test.select(y).crossJoin(F.broadcast(guess)), y)  # one row


def as_long_form(metrics: DataFrame, prefix: str = "") -> DataFrame:
    """One-row metrics to (name, value) rows."""
    return metrics.unpivot([], metrics.columns, "name", "value").select(
        F.concat(F.lit(prefix), "name").alias("name"), F.col("value").cast("double").alias("value")
    )
