"""Target and prediction transforms of the regression stage."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_log(days: Column | str) -> Column:
    return F.log1p(days)


def from_log(pred: Column | str, horizon: float) -> Column:
    """Back to days, kept inside [0, horizon]; null stays null."""
    days = F.expm1(pred)
    return F.when(days.isNotNull(), F.greatest(F.least(days, F.lit(float(horizon))), F.lit(0.0)))


def short_weight(days: Column | str) -> Column:
    """Quick closes weigh more: 1 / sqrt(1 + days)."""
    c = F.col(days) if isinstance(days, str) else days
    return F.lit(1.0) / F.sqrt(F.lit(1.0) + c)
