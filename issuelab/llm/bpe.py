"""Byte-level BPE: encoding by replaying the merges over a slice of the corpus at once, and decoding.

A slice (one Arrow batch of a partition) is cut into words by the vocabulary's pattern, and each distinct
word is encoded once. All of them lie in one array of symbols with links to the neighbours on either side.
An inverted index takes each mergeable pair, known by the rank of what it makes, to the places where it
stands; ranks are worked off from the lowest, and a merge touches only its place and the two neighbouring
pairs, which are entered under their new ranks. The replay keeps each word's order of merges exact: words
in which a merge opens a pair of lower rank than its own are done again one merge at a time.

Words never depend on other words, so slices need no exchange, nothing is shuffled, and a lost task is
redone on its own.

Defined results: null and empty texts have no ids and decode to nothing. Repeated rows are encoded alike.
Columns with the name of a result column are replaced. An empty table stays empty. Very long texts are
read a segment at a time.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from issuelab.llm.common import bounded_batches, kept_in_worker, text_of

NONE = np.int32(1 << 30)


class Merges:
    """Ranks of a vocabulary file (base64 token, rank) as a table from symbol pairs to ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        keys, made = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1) << 62)
        self.made = np.append(np.array(made, np.int32)[order], NONE)
        self.bytes = np.array([self.ranks[bytes([k])] for k in range(256)], np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def one_by_one(self, word: bytes) -> list[int]:
        """The lowest pair of the word first, leftmost among equals."""
        parts = [self.ranks[word[k : k + 1]] for k in range(len(word))]
        if word in self.ranks:
            return [self.ranks[word]]
        while len(parts) > 1:
            found = [
                self.ranks.get(self.tokens[a] + self.tokens[b], NONE) for a, b in zip(parts[:-1], parts[1:])
            ]
            low = min(found)
            if low == NONE:
                break
            k = found.index(low)
            parts[k : k + 2] = [low]
        return parts


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """Packed ids (little-endian unsigned 32-bit) of each word."""
    if not words:
        return []
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = sizes.cumsum()
    symbol = merges.bytes[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbol)
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    # Place n is a stop on both sides; its symbol pairs with nothing.
    symbol = np.append(symbol, np.int32((1 << 20) - 1))
    after = np.append(np.arange(1, n + 1, dtype=np.int32), np.int32(n))
    after[ends[ends > 0] - 1] = n
    before = np.append(np.arange(-1, n - 1, dtype=np.int32), np.int32(n))
    starts = (ends - sizes)[sizes > 0]
    before[starts] = n
    rank = np.full(n + 1, NONE, np.int32)
    rank[:n] = merges.pair_ranks(symbol[:n], symbol[after[:n]])

    # The inverted index: places by rank, first as slices of one sorted array, later also as additions.
    order = np.argsort(rank[:n], kind="stable").astype(np.int32)
    ranked = rank[order]
    known, first = np.unique(ranked, return_index=True)
    bounds = np.append(first, n)
    index = {int(r): [order[bounds[k] : bounds[k + 1]]] for k, r in enumerate(known) if r != NONE}
    heap = list(index)
    heapq.heapify(heap)
    irregular: list[np.ndarray] = []
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r, None)
        if lists is None:
            continue
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[rank[at] == r]
        if not len(at):
            continue
        right = after[at]
        if len(at) > 1 and np.isin(right, at, assume_unique=True).any():
            at = _leftmost(at, after)  # runs such as aaa: places that a merge to the left uses up drop out
            right = after[at]
        beyond = after[right]
        symbol[at] = r
        rank[right] = NONE
        after[at] = beyond
        before[beyond] = at
        before[n] = n
        left = before[at]
        touched = np.concatenate([at, left[left != n]])
        fresh = merges.pair_ranks(symbol[touched], symbol[after[touched]])
        rank[touched] = fresh
        rank[n] = NONE
        lower = fresh < r
        if lower.any():
            irregular.append(word_of[touched[lower]])
        _enter(index, heap, touched, fresh)
    alive = np.ones(n + 1, bool)
    alive[n] = False
    # A place is alive if it is reached by the links: the first place of a word, or the next of an alive one.
    linked = np.zeros(n + 1, bool)
    linked[starts] = True
    step = starts
    while len(step):
        step = after[step]
        step = step[step != n]
        linked[step] = True
    alive &= linked
    ids = symbol[alive].astype("<u4")
    counts = np.bincount(word_of[alive[:n]], minlength=len(words))
    raw, stops = ids.tobytes(), (counts.cumsum() * 4).tolist()
    out, at_byte = [], 0
    for stop in stops:
        out.append(raw[at_byte:stop])
        at_byte = stop
    for k in set(np.concatenate(irregular).tolist()) if irregular else ():
        out[k] = np.array(merges.one_by_one(words[k]), "<u4").tobytes()
    return out


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places in ascending order, those not taken up by the merge at the place before."""
    kept, used = [], -1
    for place, right in zip(at.tolist(), after[at].tolist()):
        if place != used:
            kept.append(place)
            used = right
    return np.array(kept, np.int32)


def _enter(index: dict[int, list], heap: list[int], places: np.ndarray, ranks: np.ndarray) -> None:
    """Enter places under their new ranks."""
    open_ = ranks != NONE
    places, ranks = places[open_], ranks[open_]
    if not len(places):
        return
    if len(places) > 1:
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        heads = [0, *cuts.tolist(), len(ranks)]
    else:
        heads = [0, 1]
    for a, b in zip(heads[:-1], heads[1:]):
        r = int(ranks[a])
        if r in index:
            index[r].append(places[a:b])
        else:
            index[r] = [places[a:b]]
            heapq.heappush(heap, r)


class Encoder:
    """Texts to packed ids. ``remember`` distinct words are kept from batch to batch of a task."""

    SEGMENT = 1 << 22

    def __init__(self, path: str, pattern: str, remember: int = 400_000):
        import regex

        # White space as the pattern means it: runs of anything else, with one space before, are independent.
        space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.runs = regex.compile(rf" ?[^{space}]+|[{space}]+(?![^{space}])|[{space}]").findall
        self.words = regex.compile(pattern).findall
        self.merges, self.remember = Merges(path), remember
        self.known: dict[str, bytes] = {}

    def _learn(self, runs: set[str]) -> None:
        parts = {run: self.words(run) for run in runs}
        words = list({w for ws in parts.values() for w in ws})
        packed = dict(zip(words, replay([w.encode() for w in words], self.merges)))
        self.known.update((run, b"".join([packed[w] for w in ws])) for run, ws in parts.items())

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self.runs(t) for t in texts]
        wanted = {r for runs in split for r in runs}
        if len(self.known) > self.remember:  # what these texts use stays, and with it the frequent words
            self.known = {r: self.known[r] for r in wanted if r in self.known}
        known = self.known
        self._learn(wanted - known.keys())
        return [b"".join([known[r] for r in runs]) for runs in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; as many texts as make up a segment are replayed together."""
        out: list[bytes] = []
        batch: list[str] = []
        room = self.SEGMENT
        for text in texts:
            if len(text) > self.SEGMENT:
                out += self._encode(batch)
                batch, room = [], self.SEGMENT
                out.append(b"".join(self._encode([s])[0] for s in _segments(text, self.SEGMENT)))
                continue
            if len(text) > room:
                out += self._encode(batch)
                batch, room = [], self.SEGMENT
            batch.append(text)
            room -= len(text)
        return out + self._encode(batch)


def _segments(text: str, size: int):
    """Parts of about ``size`` characters, cut before a single space between two letters or digits."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalnum() and text[cut + 1 : cut + 2].isalnum()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode(path: str, pattern: str) -> Callable[[Column], Column]:
    """Column function: text to packed ids."""

    call = uuid.uuid4().hex

    @F.arrow_udf(BinaryType())
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept_in_worker("bpe encoder", call, lambda: Encoder(path, pattern))
        for texts in parts:
            yield pa.array(encoder.encode(texts.to_pylist()), pa.binary())

    return run


def decode(path: str) -> Callable[[Column], Column]:
    """Column function: packed ids to bytes."""

    call = uuid.uuid4().hex

    @F.arrow_udf(BinaryType())
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = kept_in_worker("bpe tokens", call, lambda: Merges(path).tokens)
        for ids in parts:
            lists = [np.frombuffer(raw, "<u4").tolist() for raw in ids.to_pylist()]
            yield pa.array([b"".join([tokens[k] for k in ks]) for ks in lists], pa.binary())

    return run


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (packed) and ``n_tokens``."""
    bounded_batches(docs.sparkSession)
    found = docs.withColumn("ids", encode(path, pattern)(text_of(text)))
    return found.withColumn("n_tokens", F.expr("octet_length(ids) div 4").cast("bigint"))


def decoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with the bytes of ``ids`` as ``decoded``."""
    return docs.withColumn("decoded", decode(path)("ids"))
