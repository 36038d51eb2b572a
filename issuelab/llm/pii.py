"""Personal data: pattern spans, and terms around them that give the same person away.

Base spans come from four patterns. The method then protects each value found (an *entity*). A term close
to the entity in any document is a candidate; over the whole corpus and whole texts it counts documents with
the entity, with the term, and with both.
With IC(e) = -log2 p(e) and PMI(t, e) = log2 p(t, e) / (p(t) p(e)), the share PMI / IC says how much of
the entity's information the term alone carries. In documents that hold the entity, terms at ``remove_at``
or more are removed and those at ``generalise_at`` or more are replaced by a general word, wherever they
stand in the text. Pairs whose share cannot get there, as the term is in too many documents, aren't counted.

Defined results: a null text counts as empty (no spans) and stays null. Rows with equal texts get equal
spans; copies count as documents. Entities or pairs in fewer than ``min_documents`` documents give no
estimate and add no spans. Input columns named like a result column are replaced. Empty tables stay empty.
Searches take time in proportion to the text, whatever it holds.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from issuelab.llm.common import bounded_batches, spare_name, text_of
from issuelab.llm.spans import ARROW_SPANS, SPAN_TYPE, as_rows, term_counts
from issuelab.operators.lookup import lookup_join
from issuelab.session import stage

KINDS = ("email", "ip", "card", "phone")
ADDED = ("removed", "general")
LABELS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "removed": "", "general": "<TERM>"}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]{3,}")
_DIGITS = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Disclosure:
    """Thresholds of the method; ``reach`` is the context on either side of an entity in characters."""

    remove_at: float = 0.95
    generalise_at: float = 0.8
    min_documents: int = 3
    reach: int = 64


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The part before ``@`` is the whole run of its characters, back to the end of the last match."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time from each whole run of numbers and dots."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        ends = []
        for part in parts:
            ends.append((at, at + len(part)))
            at += len(part) + 1
        for k in range(0, len(parts) - 3, 4):
            four = [p.lstrip("0") for p in parts[k : k + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in four):
                yield ends[k][0], ends[k + 3][1]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by kind as listed, then by start."""
    finders = zip(KINDS, (_emails, _ips, _cards, _phones))
    return [(kind, a, b) for kind, find in finders for a, b in find(text)]


def _entity(text: str, kind: str, start: int, end: int) -> str:
    value = text[start:end]
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGITS.findall(value))}"


def _terms(text: str, a: int, b: int, inside: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Whole terms between two places; terms inside base spans (``inside``, ordered) don't count."""
    taken = [s for s in inside if s[0] < b and s[1] > a] if len(inside) < 50 else _near(inside, a, b)
    for m in _TERM.finditer(text, a, b):
        s, e = m.span()
        whole = (s == 0 or not text[s - 1].isalnum()) and (e == len(text) or not text[e].isalnum())
        if whole and not any(x < e and y > s for x, y in taken):
            yield m.group().lower(), s, e


def contexts(text: str, reach: int) -> set[tuple[str, str]]:
    """(entity, term) of the terms near each entity, and (entity, "") for each entity."""
    base = base_spans(text)
    inside = sorted((a, b) for _, a, b in base)
    found: set[tuple[str, str]] = set()
    for kind, start, end in base:
        entity = _entity(text, kind, start, end)
        found.add((entity, ""))
        for a, b in ((max(0, start - reach), start), (end, min(len(text), end + reach))):
            found.update((entity, term) for term, _, _ in _terms(text, a, b, inside))
    return found


def occurrences(text: str, kinds: dict[str, str]) -> list[tuple[str, int, int]]:
    """Every place of the given terms in the whole text, outside base spans."""
    inside, out, k = sorted((a, b) for _, a, b in base_spans(text)), [], 0
    for m in _TERM.finditer(text):
        kind = kinds.get(m.group().lower())
        if kind is None:
            continue
        s, e = m.span()
        while k < len(inside) and inside[k][1] <= s:
            k += 1
        # Base spans of two kinds may overlap: none of the few that start before the term's end may reach it.
        if not any(x < e and y > s for x, y in inside[k : bisect_left(inside, (e, 0))]):
            out.append((kind, s, e))
    return out


def _near(spans: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    k, out = bisect_left(spans, (b, 0)), []
    while k and spans[k - 1][0] >= a - 4096:
        k -= 1
        if spans[k][1] > a:
            out.append(spans[k])
    return out


_CONTEXT_TYPE = ArrayType(StructType().add("entity", StringType()).add("term", StringType()))
_ARROW_CONTEXT = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))


def _find_contexts(reach: int) -> Column:
    @F.arrow_udf(_CONTEXT_TYPE)
    def find(text: pa.Array) -> pa.Array:
        rows = [[{"entity": e, "term": t} for e, t in sorted(contexts(x, reach))] for x in text.to_pylist()]
        return pa.array(rows, type=_ARROW_CONTEXT)

    return find


@F.arrow_udf(ArrayType(StringType()))
def _all_terms(text: pa.Array) -> pa.Array:
    """Distinct terms of the whole text, as ``term_documents`` counts them; none for a text without base spans."""
    rows = [sorted(set(map(str.lower, _TERM.findall(t)))) if base_spans(t) else [] for t in text.to_pylist()]
    return pa.array(rows, type=pa.list_(pa.string()))


def _marked(text: str, terms: list[dict] | None) -> list[dict]:
    """Spans of the method, by kind, then start."""
    if not terms:
        return []
    found = as_rows(occurrences(text, {x["term"]: x["kind"] for x in terms}))
    return sorted(found, key=lambda s: (s["kind"], s["start"], s["end"]))


_BOTH_TYPE = StructType().add("base", SPAN_TYPE).add("extra", SPAN_TYPE)


# One function does all that a text needs, so that a task keeps one Python worker busy and not several.
@F.arrow_udf(_BOTH_TYPE)
def _find_all(text: pa.Array, terms: pa.Array) -> pa.Array:
    rows = [
        {"base": as_rows(base_spans(t)), "extra": _marked(t, own)} for t, own in zip(text.to_pylist(), terms.to_pylist())
    ]
    return pa.array(rows, type=pa.struct([("base", ARROW_SPANS), ("extra", ARROW_SPANS)]))


@F.arrow_udf(StringType())
def _cleaned(text: pa.Array, terms: pa.Array) -> pa.Array:
    out = []
    for t, own in zip(text.to_pylist(), terms.to_pylist()):
        spans = [] if t is None else as_rows(base_spans(t)) + _marked(t, own)
        out.append(_rewrite(t, spans) if spans else t)
    return pa.array(out, type=pa.string())


def term_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, documents) over the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = term_counts(batch.column(0).to_pylist(), _TERM)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["term", "n"],
            )

    parts = docs.select(text_of(text).alias("t")).mapInArrow(count, "term string, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("term_docs"))


def _text_key(text: str) -> Column:
    """128 bits of a text's content."""
    value = text_of(text)
    return F.concat_ws("-", F.xxhash64(value), F.xxhash64(F.lit("second"), value))


def _share(both: Column) -> Column:
    """PMI / IC from the documents with both, and columns ``n``, ``entity_docs`` and ``term_docs``."""
    information = F.log2(F.col("n") / F.col("entity_docs"))
    pmi = F.log2(both * F.col("n") / (F.col("term_docs") * F.col("entity_docs")))
    return F.when(information > 0, pmi / information)


def disclosing_terms(docs: DataFrame, rules: Disclosure = Disclosure(), text: str = "text") -> DataFrame:
    """One row per distinct text with such terms: ``text_key``, ``terms`` (term, kind), ``copies``."""
    found = docs.select(_text_key(text).alias("text_key"), _find_contexts(rules.reach)(text_of(text)).alias("c"))
    found = found.select("text_key", F.explode("c").alias("c")).select("text_key", "c.entity", "c.term")
    found = stage(found.groupBy("text_key", "entity", "term").agg(F.count("*").alias("copies")), "contexts")
    total = docs.select(F.count("*").alias("n"))
    per_entity = found.where("term = ''").groupBy("entity").agg(F.sum("copies").alias("entity_docs"))
    per_entity = per_entity.where(F.col("entity_docs") >= rules.min_documents)
    # Candidates: pairs that are near in any document, and could reach a threshold by what their sides allow.
    near = found.where("term <> ''").select("entity", "term").distinct()
    near = lookup_join(near, per_entity, "entity", weight="entity_docs", spread_by=("term",)).where("entity_docs is not null")
    of_term = term_documents(docs, text).where(F.col("term_docs") >= rules.min_documents)
    near = near.join(of_term, "term").crossJoin(F.broadcast(total))  # one row
    at_most = F.least("entity_docs", "term_docs")
    pairs = near.where(_share(at_most) >= rules.generalise_at).withColumn("at_most", at_most)
    pairs = stage(pairs.withColumn("pair", F.xxhash64("entity", "term")), "pairs")
    # Candidate terms of each text, wherever they stand, meet the entities of the text.
    terms = pairs.groupBy("term").agg(F.max("term_docs").alias("weight"))
    held = docs.select(_text_key(text).alias("text_key"), _all_terms(text_of(text)).alias("terms"))
    held = held.select("text_key", F.explode("terms").alias("term"))
    held = lookup_join(held, terms, "term", weight="weight", spread_by=("text_key",)).where("weight is not null")
    held = held.select("text_key", "term").distinct()
    entities = found.where("term = ''").select("text_key", "entity", "copies")
    wanted = pairs.groupBy("entity").agg(F.max("entity_docs").alias("weight"))
    entities = lookup_join(entities, wanted, "entity", weight="weight", spread_by=("text_key",)).where("weight is not null")
    both = entities.drop("weight").join(held, "text_key").withColumn("pair", F.xxhash64("entity", "term"))
    sizes = pairs.select("pair", "at_most", "entity_docs", "term_docs", "n")
    both = lookup_join(both.select("text_key", "term", "copies", "pair"), sizes, "pair", weight="at_most", spread_by=("text_key",))
    both = stage(both.where("at_most is not null"), "both")
    counted = both.groupBy("pair", "entity_docs", "term_docs", "n").agg(F.sum("copies").alias("both_docs"))
    counted = counted.where(F.col("both_docs") >= rules.min_documents).withColumn("share", _share(F.col("both_docs")))
    flagged = counted.where(F.col("share") >= rules.generalise_at).select(
        "pair",
        F.when(F.col("share") >= rules.remove_at, F.lit("removed")).otherwise(F.lit("general")).alias("kind"),
        "both_docs",
    )
    # A pair seen very often is looked up without gathering its rows in one task.
    told = both.select("text_key", "term", "copies", "pair")
    told = lookup_join(told, flagged, "pair", weight="both_docs", spread_by=("text_key",)).where("kind is not null")
    # A term told by two entities is removed if either asks for it.
    told = told.groupBy("text_key", "term").agg(F.max("kind").alias("kind"), F.max("copies").alias("copies"))
    return told.groupBy("text_key").agg(
        F.collect_list(F.struct("term", "kind")).alias("terms"), F.max("copies").alias("copies")
    )


def _with_terms(docs: DataFrame, rules: Disclosure, text: str) -> tuple[DataFrame, str, list[str]]:
    """``docs`` with the disclosing terms of each text; the column that holds them, and all columns added."""
    bounded_batches(docs.sparkSession)
    key, more, copies = (spare_name(docs, c) for c in ("text_key", "added", "copies"))
    added = disclosing_terms(docs, rules, text).toDF(key, more, copies)
    keyed = docs.withColumn(key, _text_key(text))
    return lookup_join(keyed, added, key, weight=copies, spread_by=tuple(docs.columns)), more, [key, more, copies]


def with_spans(docs: DataFrame, rules: Disclosure = Disclosure(), text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: base spans by kind, then start; then the method's by kind, then start."""
    keyed, more, helpers = _with_terms(docs, rules, text)
    found = spare_name(keyed, "found")
    both = keyed.withColumn(found, _find_all(text_of(text), F.col(more)))
    both = both.withColumn("base", F.col(found)["base"]).withColumn("spans", F.concat(F.col(found)["base"], F.col(found)["extra"]))
    return both.drop(found, *helpers)


def _rewrite(text: str, spans: list[dict]) -> str:
    """Each stretch of overlapping spans gives way to the label of its first span."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], LABELS[s["kind"]]]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, rules: Disclosure = Disclosure(), text: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms taken out of the text; other columns as they are."""
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).cast("string").alias("text"))
    keyed, more, _ = _with_terms(held, rules, "text")
    found = keyed.select("row", _cleaned(F.col("text"), F.col(more)).alias("text"))
    kept = [F.col("text") if c == text else F.col("row")[c] for c in docs.columns]
    return found.select(*[k.alias(c) for k, c in zip(kept, docs.columns)])
