"""Label rules. Four readings of "bug" are in use; they differ on purpose and are kept apart."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from issuelab.schemas import LABEL_KEYWORDS


def has_exact(name: str, labels: str = "labels") -> Column:
    """Exact, case-sensitive element. Null array, or a null element and no hit, gives null."""
    return F.array_contains(labels, name)


def any_matches(pattern: str, labels: str = "labels") -> Column:
    """Some element matches the pattern anywhere, ignoring case."""
    hit = F.exists(labels, lambda x: F.regexp_like(x, F.lit(f"(?i){pattern}")))
    return F.coalesce(hit, F.lit(False))


def joined_contains(keyword: str, joined: str = "labels_str") -> Column:
    """Case-insensitive substring of the joined labels."""
    return F.coalesce(F.contains(F.lower(joined), F.lit(keyword.lower())), F.lit(False))


def keyword_flags(joined: str = "labels_str") -> dict[str, Column]:
    """The seven 0/1 model flags. "doc" also fires on "docker", as in the training data."""
    return {
        name: reduce(lambda a, b: a | b, [joined_contains(k, joined) for k in words]).cast("double")
        for name, words in LABEL_KEYWORDS.items()
    }


def without_nulls(labels: str = "labels") -> Column:
    """Array without null elements; a missing array is empty."""
    return F.coalesce(F.filter(labels, lambda x: x.isNotNull()), F.array().cast("array<string>"))
