"""Secrets: pattern spans, and strings in a sensitive place that a primed compressor cannot shorten.

Base spans come from three patterns. The method takes every long string close to a sensitive word, before or
after it, without what base spans cover, and measures the bytes that each adds to a zstandard frame of the text before it. The compressor is primed
with a dictionary of the corpus's most frequent identifiers (and common code words), so ordinary names
cost little and random keys cost almost their length. Strings whose marginal bytes per character reach
``novelty`` are reported as kind ``novel``. A string is measured by its assigned parts first (``name=value``),
then as a whole, from its first sensitive word on, and between its sensitive words, until one is reported.

Defined results: a null text counts as empty. Rows are judged one by one against the same dictionary, so
repeated rows get the same spans; ties in the dictionary go to the smaller word. An empty table has an
empty dictionary and stays empty. Columns named ``base`` or ``spans`` are replaced. Time is in proportion
to the text: the context of a candidate is bounded.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from issuelab.llm.common import bounded_batches, text_of
from issuelab.llm.spans import ARROW_SPANS, SPAN_TYPE, as_rows, code_point_places, term_counts

KINDS = ("assign", "access", "hex")

_KEYWORD = re.compile(rb"password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_SENSITIVE = re.compile(rb"key|secret|token|passw|credential|bearer|private|auth")
_RUN = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_ASSIGNED = re.compile(rb"=+(?=[^=])")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{3,30}")

#: Words that surround secrets in code and settings.
CODE_WORDS = (
    "import from return class def function public private static const let var self this None null true false "
    "string int bool config settings environ export client server user username password secret token api_key "
    "access_key authorization bearer http https localhost example version default value name"
).split()


@dataclass(frozen=True)
class Novelty:
    """Limits of the method: bytes added per character, shortest candidate, context and reach in bytes.

    The reach is the most that lies between a candidate and a sensitive word.
    """

    novelty: float = 0.55
    min_length: int = 16
    context: int = 256
    reach: int = 40
    dictionary_words: int = 4096


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, ordered."""
    found, at = [], 0
    lowered = raw.lower()
    while m := _KEYWORD.search(lowered, at):
        whole = _ASSIGN.match(raw, m.start())
        if whole is None:
            at = m.start() + 1
            continue
        at = whole.end()
        if len(whole.group(2)) >= 6:
            found.append((whole.start(), 0, whole.end()))
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(raw)]
    return sorted(found)


def dictionary(docs: DataFrame, words: int, text: str = "text") -> bytes:
    """The ``words`` most frequent identifiers of the whole table, most frequent last, then code words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = term_counts(batch.column(0).to_pylist(), _IDENTIFIER)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )

    parts = docs.select(text_of(text).alias("t")).mapInArrow(count, "term string, n bigint")
    top = parts.groupBy("term").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "term").limit(words)
    frequent = [r["term"] for r in top.collect()]  # at most ``words`` of at most 31 characters
    return " ".join([*reversed(frequent), *CODE_WORDS]).encode()


class _Meter:
    """Marginal compressed bytes under one dictionary."""

    def __init__(self, primer: bytes):
        primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=3)
        self.zstd = zstandard.ZstdCompressor(dict_data=primed)

    def added(self, before: bytes, candidate: bytes) -> int:
        return len(self.zstd.compress(before + candidate)) - len(self.zstd.compress(before))


def _runs(raw: bytes, words: list[tuple[int, int]], rules: Novelty) -> Iterator[tuple[int, int]]:
    """Whole runs of at least the least length within reach of a sensitive word, on either side or around it."""
    pattern = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % rules.min_length)
    done = 0
    for start, end in words:
        at, last = max(done, start - rules.reach), end + rules.reach
        while at > done and raw[at - 1] in _RUN:
            at -= 1
        # A run that starts by ``last`` shows its least length by there, and is then followed to its end.
        while m := pattern.search(raw, at, last + rules.min_length):
            at = pattern.match(raw, m.start()).end()
            yield m.start(), at
        done = max(at, last + 1)


def _uncovered(runs: Iterator[tuple[int, int]], base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What base spans (ordered by start) leave of the runs."""
    covered, k = [], 0
    for a, _, b in base:
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(b, covered[-1][1])
        else:
            covered.append([a, b])
    for start, end in runs:
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        while k < len(covered) and covered[k][0] < end:
            if start < covered[k][0]:
                yield start, covered[k][0]
            start = covered[k][1]
            if start >= end:
                break
            k += 1
        if start < end:
            yield start, end


def _between(start: int, end: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts from ``start`` to ``end`` without the cuts, which lie in it in order."""
    return list(zip([start, *(b for _, b in cuts)], [*(a for a, _ in cuts), end]))


def novel_spans(raw: bytes, base: list[tuple[int, int, int]], meter: _Meter, rules: Novelty) -> list[tuple[int, int]]:
    """Byte spans of reported candidates, in order."""
    words, found = [m.span() for m in _SENSITIVE.finditer(raw.lower())], []
    if not words:
        return found

    def novel(part: tuple[int, int]) -> bool:
        a, b = part
        if b - a < rules.min_length:
            return False
        return meter.added(raw[max(0, a - rules.context) : a], raw[a:b]) >= rules.novelty * (b - a)

    for start, end in _uncovered(_runs(raw, words, rules), base):
        if end - start < rules.min_length:
            continue
        assigned = _between(start, end, [m.span() for m in _ASSIGNED.finditer(raw, start, end) if m.end() < end])
        inside = [w for w in words[bisect_left(words, (start, 0)) : bisect_left(words, (end, 0))] if w[1] <= end]
        tries = [assigned, [(start, end)]]
        if inside:
            tries += [[(inside[0][1], end)], _between(start, end, inside)]
        for parts in tries:
            if own := [p for p in parts if novel(p)]:
                found += own
                break
    return found


def with_spans(docs: DataFrame, rules: Novelty = Novelty(), text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``, both by start, then kind as listed (``novel`` last)."""
    bounded_batches(docs.sparkSession)
    primer = dictionary(docs, rules.dictionary_words, text)

    @F.arrow_udf(StructType().add("base", SPAN_TYPE).add("spans", SPAN_TYPE))
    def scan(texts: pa.Array) -> pa.Array:
        meter, bases, alls = _Meter(primer), [], []
        names = (*KINDS, "novel")
        for value in texts.to_pylist():
            raw = value.encode("utf-8", "surrogatepass")
            base = base_spans(raw)
            every = sorted([*base, *((a, 3, b) for a, b in novel_spans(raw, base, meter, rules))])
            if every and not value.isascii():
                place = code_point_places(raw, [p for a, _, b in every for p in (a, b)])
                base = [(place[a], k, place[b]) for a, k, b in base]
                every = [(place[a], k, place[b]) for a, k, b in every]
            bases.append(as_rows((names[k], a, b) for a, k, b in base))
            alls.append(as_rows((names[k], a, b) for a, k, b in every))
        return pa.StructArray.from_arrays(
            [pa.array(bases, ARROW_SPANS), pa.array(alls, ARROW_SPANS)], names=["base", "spans"]
        )

    found = docs.withColumn("spans", scan(text_of(text)))
    return found.withColumn("base", F.col("spans.base")).withColumn("spans", F.col("spans.spans"))
