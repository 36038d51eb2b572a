"""Spans as rows of (kind, start, end) in code points, end exclusive, and what queries show of them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

SPAN_TYPE = ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType()))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def as_rows(spans) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def code_point_places(raw: bytes, places: list[int]) -> dict[int, int]:
    """Code-point offsets of ascending byte offsets, in one pass."""
    out, at, count = {}, 0, 0
    for place in sorted(set(places)):
        count += len(raw[at:place].decode("utf-8", "surrogatepass"))
        at = place
        out[place] = count
    return out


def term_counts(texts, pattern):
    """(term, documents) of a batch of texts; terms are the lower-cased matches of ``pattern``."""
    from collections import Counter

    counts: Counter[str] = Counter()
    for text in texts:
        if text:
            counts.update(set(map(str.lower, pattern.findall(text))))
    return counts
