"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Each rule bounds one measure of the text. ``measures`` is one projection over the row (no shuffle, no
user function), ``verdict`` turns the table into one boolean expression over it.

Defined results: a null text counts as an empty one; it has no words and is rejected. Rows are judged
one by one, so repeated rows are judged alike, and an empty table gives an empty table. Input columns
with the name of a measure are replaced by the measure. Ratios over nothing are zero. Windows are told
apart by a 64-bit hash of the hashes of their eight words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.llm.common import bind, spare_name, text_of, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: Frequent function words by language.
STOP_WORDS = {
    "en": "the of and to in is that it was for on as with be by this from or are at an not a he have had".split(),
    "de": "der die und das in den von zu mit sich des auf ist im dem nicht ein eine als auch es an er so".split(),
    "fr": "le la les de des et un une du en que qui dans pour au sur pas par il est ce se plus ne".split(),
    "es": "el la los de que y en un una por con no para es se del las su al lo como más o pero".split(),
}


@dataclass(frozen=True)
class Rule:
    """Text passes while ``low <= scale * measure / per <= high``; an absent bound is open."""

    name: str
    measure: str
    per: str | None = None
    scale: int = 1
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars", per="n_words", low=1.5, high=25),
    Rule("symbols_per_100_words", "n_symbols", per="n_words", scale=100, high=25),
    Rule("stop_words_per_100_words", "n_stop_words", per="n_words", scale=100, low=2),
    Rule("duplicate_lines_percent", "n_dup_lines", per="n_lines", scale=100, high=60),
)


def _window_hashes(words: Column) -> Column:
    """A hash for each run of ``WINDOW`` words; empty for shorter texts."""
    windows = bind(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        ),
    )
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(windows)


def _covered(windows: Column) -> Column:
    """Words covered by repeated windows: sort by hash, keep equal neighbours, join overlaps."""
    same = lambda a, b: a["h"].eqNullSafe(b["h"])
    repeated = bind(
        F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda s: F.filter(s, lambda x, k: same(F.get(s, k - 1), x) | same(F.get(s, k + 1), x)),
    )
    step = lambda p: lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
    return bind(
        F.array_sort(F.transform(repeated, lambda x: x["i"])),
        lambda p: F.aggregate(
            F.transform(p, step(p)), F.lit(0).cast("bigint"), lambda total, x: total + x
        ),
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that rules may use."""
    words_, text_, windows_, lines_ = (spare_name(docs, c) for c in ("_words", "_text", "_windows", "_lines"))
    wide = docs.withColumns({words_: words_of(text_of(text)), text_: text_of(text)})
    words, value, windows, lines = (F.col(c) for c in (words_, text_, windows_, lines_))
    wide = wide.withColumns(
        {
            windows_: _window_hashes(words),
            lines_: F.filter(F.split(value, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
        }
    )
    stops = sorted({w for group in STOP_WORDS.values() for w in group})
    long = lambda c: c.cast("bigint")
    counts = {
        "n_words": long(F.size(words)),
        "word_chars": long(F.length(F.translate(value, SPACES, ""))),
        "n_symbols": long(F.length(value) - F.length(F.translate(value, SYMBOLS, ""))),
        "n_lines": long(F.size(lines)),
        "n_dup_lines": long(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_stop_words": long(F.size(F.filter(words, lambda w: F.lower(w).isin(stops)))),
        "n_repeat_words": F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")
        ).otherwise(_covered(windows)),
    }
    return wide.withColumns(counts).drop(words_, text_, windows_, lines_)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules of the table as one expression; compared without division, so it is exact."""
    checks = []
    for rule in rules:
        value = F.col(rule.measure) * F.lit(rule.scale)
        base = F.col(rule.per) if rule.per else F.lit(1)
        if rule.low is not None:
            checks.append(value >= F.lit(rule.low) * base)
        if rule.high is not None:
            checks.append(value <= F.lit(rule.high) * base)
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``."""
    counted = measures(docs, text)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Only the rows that pass, with their own columns."""
    judged = judge(docs.select(F.struct(*docs.columns).alias("row"), "text"), rules)
    return judged.where("kept").select("row.*")
