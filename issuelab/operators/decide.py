"""Turning scores into decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the triage rules.
RISK_CUT = 0.26
FAST_CUT = 0.31
BOOST_FROM = 60.0


def risk_band(score: str, cut: float = RISK_CUT) -> Column:
    """Red below the cut, else green; no score, no band."""
    return F.when(F.col(score) < cut, "red").when(F.col(score).isNotNull(), "green")


def triage(
    df: DataFrame, p: str = "p", log_days: str = "r", cut: float = FAST_CUT, boost_from: float = BOOST_FROM
) -> DataFrame:
    """Fast or slow, and days raised by how far the probability lies under ``boost_from`` percent."""
    zero = F.lit(0.0)
    days = F.greatest(zero, F.expm1(log_days)) + F.greatest(zero, boost_from - F.col(p) * 100)
    fast = F.col(p) >= cut
    return df.withColumns(
        {
            "is_fast": fast,
            "est_days": F.when(F.col(p).isNotNull() & F.col(log_days).isNotNull(), days),
            "shown": F.when(fast, F.concat(F.format_number(days, 1), F.lit(" days"))).otherwise(
                "> 30 days"
            ),
        }
    )


def score_response(
    df: DataFrame,
    threshold: float,
    embed_model: str,
    classifier_version: str,
    regressor_version: str,
    p: str = "p",
    days: str = "r",
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """The seven response columns of the scoring service; the day estimate is passed on as it is."""
    return df.select(
        *keep,
        F.col(p).alias("prob_resolved_30d"),
        (F.col(p) >= threshold).cast("int").alias("predicted_label_resolved_30d"),
        F.col(days).alias("predicted_days_to_close"),
        F.lit(embed_model).alias("embed_model"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(classifier_version).alias("classifier_version"),
        F.lit(regressor_version).alias("regressor_version"),
    )
