"""Packing: documents in order into sequences of at most ``size`` tokens, cuts chosen by dynamic programming.

A document is its tokens and an end id. The stream of documents of a table slice (one input partition)
is cut into windows. Cuts are wanted at document ends (free), allowed at sentence ends (``sentence``) and,
so that every window can be filled, every ``grid`` tokens of a document (``anywhere``). Over these places
the dynamic program minimises padding plus penalties:

    cost[j] = penalty[j] + min over i, end[j] - end[i] <= size, of cost[i] + size - (end[j] - end[i])

and the last cut is the cheapest one within ``size`` of the end.

The minimum over the sliding window of places is kept in a monotone queue, so each place costs O(1). What
is left at the end of a slice goes to sequences whose lengths are powers of two, which need no padding.
The stream is worked off in blocks of bounded length, carrying on the last cut, so memory does not grow
with the slice. Nothing is shuffled; a lost task is redone on the same slice with the same result.

Defined results: a null text counts as empty and is one token (the end id). Repeated rows are packed as
often as they occur; a null ``doc_id`` stays null. Long texts are cut over several sequences. An empty
table has no pieces. Only ``doc_id`` and ``text`` are read, so other columns cannot clash. Sequence ids are
unique but not gapless: partition number times 2^33 plus a count.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelab.llm.common import bounded_batches, kept_in_worker, release_memory, text_of

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


@dataclass(frozen=True)
class Penalties:
    """Costs of a cut, in padded tokens; ``grid`` is the spacing of cuts inside sentences.

    A cut inside a sentence costs more than the usual way to a sentence's end, so it is made only where sentences
    are long.
    """

    sentence: float = 0.5
    anywhere: float = 512.0
    grid: int = 16


#: Kinds of characters, as the vocabulary's splitter tells them apart; runs with an odd one are split one by one.
_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
#: Code points in the character tables; all above share the last entry.
_TOP = 1 << 16


def _character_tables(odd: str) -> tuple[np.ndarray, np.ndarray]:
    """Kind, and lower case, of each code point.

    Odd are the characters of ``odd``, and those that may compose with another one, whose lower case is longer, of
    another kind or depends on what stands around them, or that lie above the tables.
    """
    import unicodedata

    import regex

    chars = "".join(chr(k) for k in range(_TOP) if not 0xD800 <= k < 0xE000)
    kinds = dict.fromkeys(chars, _OTHER)
    kinds.update(dict.fromkeys(regex.findall(r"\p{L}", chars), _LETTER))
    kinds.update(dict.fromkeys(regex.findall(r"\p{N}", chars), _NUMBER))
    jamo = regex.compile(r"[\u1100-\u11ff\ua960-\ua97f\ud7b0-\ud7ff]").match
    kind, lower = np.full(_TOP + 1, _ODD, np.uint8), np.arange(_TOP + 1, dtype=np.uint32)
    for c in chars:
        small = c.lower()
        if c.isspace():
            kind[ord(c)] = _SPACE
        elif (
            c not in odd
            and kinds.get(small) == kinds[c]
            and unicodedata.category(c)[0] != "M"
            and not jamo(c)
            and unicodedata.is_normalized("NFC", c)
        ):
            kind[ord(c)], lower[ord(c)] = kinds[c], ord(small)
    return kind, lower


class WordTokens:
    """Token ids of whole texts by a word-level vocabulary, each distinct piece encoded once.

    The vocabulary's normaliser and splitter work on the runs between white space one by one. Most runs are cut into
    pieces by the kinds of their characters, for many texts at once; runs with an odd character are pieces themselves,
    split by the vocabulary's rule when they are new. Every split piece ends in a token with a word-end mark, so new
    pieces are encoded many at a time and cut apart at the marks. Texts with control characters on which Python and the
    tokenizer differ about white space, and runs that hold a special token, are encoded whole.
    """

    _CONTROL = "\x1c\x1d\x1e\x1f"
    SEGMENT = 1 << 20

    def __init__(self, path: str, end_id: int, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.remember = remember  # pieces, 200 bytes or so each
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.closes[number] = token.endswith("</w>")
        # Special tokens are read inside texts, too. All begin alike; without a common start every run is read whole.
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.opening = os.path.commonprefix(special) if special else "\x00"
        # Fixed value: the splitting rule of the vocabulary. Where it is more than the kinds of characters, by an
        # apostrophe, runs are odd.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.kind, self.lower = _character_tables("'Σ" + self.opening[:1])
        if not self.opening:
            self.kind[self.kind != _SPACE] = _ODD
        # Pieces met lately and before; those met again move up, the others go when the first half is full.
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, plain: list[str], odd: list[str]) -> None:
        """Encode unknown pieces, and unknown runs with odd characters."""
        split = {}
        for run in odd:
            if self.opening in run or not run.isascii() and self._needs_whole(run):
                self.known[run] = self._encode(run)
            else:
                split[run] = self.split(run.lower())
        new = list({*plain, *(p for parts in split.values() for p in parts)})
        joined = [" ".join(new[k : k + 512]) for k in range(0, len(new), 512)]
        pieces: dict[str, bytes] = {}
        for k, got in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            group = new[k * 512 : (k + 1) * 512]
            if len(ends) != len(group):  # a piece that the tokenizer splits in another way
                pieces.update((p, self._encode(p)) for p in group)
                continue
            raw, at = ids.tobytes(), 0
            for piece, end in zip(group, (ends * 4).tolist()):
                pieces[piece] = raw[at:end]
                at = end
        for piece in plain:
            self.known[piece] = pieces[piece]
        for run, parts in split.items():
            self.known[run] = b"".join([pieces[p] for p in parts])

    def _needs_whole(self, run: str) -> bool:
        """Runs whose composition or lower case could change how they split."""
        import unicodedata

        return not unicodedata.is_normalized("NFC", run) or len(run.lower()) != len(run) or "Σ" in run

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """For each text its packed ids, the tokens of each piece, and which pieces end a sentence."""
        group, held = [], 0
        for text in texts:
            if group and held + len(text) > self.SEGMENT:
                for raw, sizes, stops in self._encode_all(group):
                    yield raw + self.end, sizes, stops
                group, held = [], 0
            if len(text) <= self.SEGMENT:
                group.append(text)
                held += len(text)
                continue
            # A long one, a segment at a time.
            raws, sizes, stops = zip(*(g for s in _segments(text, self.SEGMENT) for g in self._encode_all([s])))
            yield b"".join(raws) + self.end, np.concatenate(sizes), np.concatenate(stops)
        for raw, sizes, stops in self._encode_all(group):
            yield raw + self.end, sizes, stops

    def _ids_of(self, keys: list[str], odd: np.ndarray) -> list[bytes]:
        """Packed ids of each of some distinct pieces."""
        if len(self.known) > self.remember // 2:
            self.known, self.former = {}, self.known
        known, former = self.known, self.former
        found = list(map(known.get, keys))
        plain, runs, missing = [], [], []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            key = keys[k]
            ids = former.get(key)
            if ids is None:
                (runs if odd[k] else plain).append(key)
                missing.append(k)
            else:
                known[key] = found[k] = ids
        self._learn(plain, runs)
        for k in missing:
            found[k] = known[keys[k]]
        return found

    def _encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        whole = {k: self._encode(t) for k, t in enumerate(texts) if any(c in t for c in self._CONTROL)}
        split = ["" if k in whole else t for k, t in enumerate(texts)]
        chars = np.frombuffer("\n".join([*split, ""]).encode("utf-32-le"), "<u4")
        kind = self.kind[np.minimum(chars, _TOP)]
        solid = np.flatnonzero(kind != _SPACE)
        chars, kind = chars[solid], kind[solid]

        begins_run = np.ones(len(solid) + 1, bool)
        begins_run[1:-1] = solid[1:] != solid[:-1] + 1
        begins = begins_run.copy()
        begins[1:-1] |= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        written = self.lower[np.minimum(chars, _TOP)]
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):  # runs with one are a piece each, in their own case
            run = begins_run[:-1].cumsum() - 1
            in_odd = np.zeros(run[-1] + 1, bool)
            in_odd[run[odd]] = True
            in_odd = in_odd[run]
            begins[:-1] &= begins_run[:-1] | ~in_odd
            written = np.where(in_odd, chars, written)
        else:
            in_odd = np.zeros(len(solid), bool)

        bounds = np.flatnonzero(begins)
        first, last = bounds[:-1], bounds[1:] - 1
        buffers = [None, pa.py_buffer(bounds * 4), pa.py_buffer(np.ascontiguousarray(written, "<u4"))]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(first), buffers).dictionary_encode()
        index, distinct = pieces.indices.to_numpy(), pieces.dictionary
        keys: list[str] = []
        if len(distinct):
            text = distinct.buffers()[2].to_pybytes().decode("utf-32-le")
            ends = (np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] // 4).tolist()
            keys = [text[a:b] for a, b in zip(ends[:-1], ends[1:])]
        key_odd = np.zeros(len(keys), bool)
        key_odd[index] = in_odd[first]
        found = self._ids_of(keys, key_odd)

        key_sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        sizes = key_sizes[index]
        shift = (key_sizes.cumsum() - key_sizes)[index] - (sizes.cumsum() - sizes)
        ids = np.frombuffer(b"".join(found), "<u4")[np.arange(sizes.sum()) + np.repeat(shift, sizes)]
        stops = begins_run[bounds[1:]] & np.isin(chars[last], [ord(c) for c in ".!?"])

        until = np.searchsorted(solid[first], np.cumsum([len(t) + 1 for t in split])).tolist()
        tokens = np.concatenate([[0], sizes.cumsum()])
        a = 0
        for k, b in enumerate(until):
            if k in whole:
                yield whole[k], np.array([len(whole[k]) // 4]), np.array([False])
            else:
                yield ids[tokens[a] : tokens[b]].tobytes(), sizes[a:b], stops[a:b]
            a = b


def _segments(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut before a space or line end where there is one."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        if cut < 0:
            nexts = [k for k in (text.find(" ", at + size), text.find("\n", at + size)) if k >= 0]
            cut = min(nexts, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def cut_places(sizes: np.ndarray, stops: np.ndarray, total: int, p: Penalties) -> tuple[np.ndarray, np.ndarray]:
    """Places (tokens from the document's start) where it may be cut, with penalties; the last is its end."""
    costs = np.full(total + 1, np.inf, np.float32)
    costs[p.grid : total : p.grid] = p.anywhere
    if len(sizes):
        ends = sizes.cumsum()[stops]
        costs[ends[(ends > 0) & (ends < total)]] = p.sentence
    costs[total] = 0
    places = np.flatnonzero(np.isfinite(costs))
    return places, costs[places]


def best_cuts(places: list[int], costs: list[float], size: int) -> list[int]:
    """Indices of the chosen cuts after the first place, which is a cut already made.

    The tokens after the last cut, at most ``size``, are left over; they cost nothing.
    """
    n = len(places)
    cost, back = [0.0] * n, [0] * n
    queue: deque[int] = deque()
    key = [0.0] * n  # cost[i] + place[i], what the minimum runs over
    key[0] = places[0]
    queue.append(0)
    for j in range(1, n):
        here = places[j]
        while places[queue[0]] < here - size:
            queue.popleft()
        i = queue[0]
        cost[j] = key[i] + size - here + costs[j]
        back[j] = i
        value = key[j] = cost[j] + here
        while queue and key[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    open_from = next(i for i, place in enumerate(places) if place >= places[-1] - size)
    chosen, j = [], min(range(open_from, n), key=lambda i: (cost[i], -i))
    while j:
        chosen.append(j)
        j = back[j]
    return chosen[::-1]


class _Stream:
    """Documents waiting to be packed, and the pieces made of them."""

    def __init__(self, size: int, penalties: Penalties, block: int, first_id: int):
        self.size, self.penalties, self.block, self.next_id = size, penalties, block, first_id
        self.docs: deque[list] = deque()  # doc id, packed ids, tokens, tokens already packed
        self.places, self.costs = [0], [0.0]  # in tokens of the waiting stream
        self.end = 0

    def add(self, doc_id, raw: bytes, sizes: np.ndarray, stops: np.ndarray) -> None:
        total = len(raw) // 4
        places, costs = cut_places(sizes, stops, total, self.penalties)
        self.places += (places + self.end).tolist()
        self.costs += costs.tolist()
        self.end += total
        self.docs.append([doc_id, raw, total, 0])

    def full(self) -> bool:
        return self.end >= self.block

    def _sequence(self, length: int) -> Iterator[tuple]:
        """The next ``length`` tokens as one sequence."""
        offset = 0
        while offset < length:
            doc = self.docs[0]
            doc_id, raw, total, done = doc
            take = min(total - done, length - offset)
            ids = raw[4 * done : 4 * (done + take)]
            yield doc_id, done, take, zlib.crc32(ids), total, self.next_id, offset, ids
            offset += take
            doc[3] += take
            if doc[3] == total:
                self.docs.popleft()
        self.next_id += 1

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pack the waiting stream; unless it is the last, its final window waits for what follows."""
        if not self.end:
            return
        chosen = best_cuts(self.places, self.costs, self.size)
        at = 0
        for j in chosen:
            yield from self._sequence(self.places[j] - at)
            at = self.places[j]
        rest = self.end - at
        if last:
            while rest:
                part = min(self.size, 1 << (rest.bit_length() - 1))
                yield from self._sequence(part)
                rest -= part
            self.places, self.costs, self.end = [0], [0.0], 0
            return
        keep = chosen[-1] if chosen else 0
        self.places = [p - at for p in self.places[keep:]]
        self.costs = self.costs[keep:]
        self.end = rest


def pack(
    docs: DataFrame,
    tokens: Callable[[], WordTokens],
    size: int = 4096,
    penalties: Penalties = Penalties(),
    block: int = 1 << 19,
    text: str = "text",
) -> DataFrame:
    """One row per piece, with its token ids (little-endian unsigned 32-bit)."""
    bounded_batches(docs.sparkSession, 2 << 20)
    call = uuid.uuid4().hex
    fields = [pa.int64()] * 7 + [pa.binary()]
    names = "doc_id start length ids_crc32 doc_tokens sequence_id offset ids".split()
    schema = pa.schema(list(zip(names, fields)))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker("word tokens", call, tokens)
        stream = _Stream(size, penalties, block, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for doc_id, (raw, sizes, stops) in zip(ids, encoder.encode(texts)):
                    stream.add(doc_id, raw, sizes, stops)
                    if stream.full():
                        yield table(list(stream.flush(last=False)))
        yield table(list(stream.flush(last=True)))
        release_memory()

    return docs.select(F.col("doc_id").cast("bigint"), text_of(text).alias("text")).mapInArrow(run, PIECES)


def word_tokens(path: str, end_id: int = 2) -> Callable[[], WordTokens]:
    return lambda: WordTokens(path, end_id)
