"""Packing: ids as the tokenizer gives them, every id once, little padding, best cuts."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from issuelab.llm import packing

from .awkward import awkward_docs, empty_docs, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(encoder, text):
    return np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


def padding(length, size=4096):
    return 0 if length & (length - 1) == 0 else size - length


def test_same_ids_as_the_library():
    encoder = packing.WordTokens(PATH, 2, remember=50)
    encoder.SEGMENT = 60
    rng = random.Random(0)
    parts = ["a", "B", "'s", "'LL", " ", "\n", "\x1c", "é", "é", "İ", "Σ", "ΑΣ", "1", "²", "<|endoftext|>", "，"]
    parts += [" ", "​", "🙂", "नी", "_", "...", "ǅ", "ﬁ", "\x00", "́", "</w>", "漢字", "\x85", "hello, world."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["ab c. " * 100]
    for at in range(0, len(texts), 37):
        part = texts[at : at + 37]
        assert [raw for raw, _, _ in encoder.encode(part)] == [library_ids(encoder, t) for t in part]


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(300):
        gaps = [rng.randint(1, 6) for _ in range(rng.randint(1, 14))]
        places = [0, *np.cumsum(gaps).tolist()]
        costs = [0.0, *(rng.choice([0.0, 1.0, 3.0]) for _ in gaps)]
        size, n = 9, len(places)
        best = [0.0] + [float("inf")] * (n - 1)
        for j in range(1, n):
            best[j] = min(
                best[i] + size - (places[j] - places[i]) + costs[j] for i in range(j) if places[j] - places[i] <= size
            )
        chosen = [0, *packing.best_cuts(places, costs, size)]
        steps = list(zip(chosen[:-1], chosen[1:]))
        assert places[-1] - places[chosen[-1]] <= size and all(places[j] - places[i] <= size for i, j in steps)
        cheapest = min(best[i] for i in range(n) if places[-1] - places[i] <= size)
        assert abs(sum(size - (places[j] - places[i]) + costs[j] for i, j in steps) - cheapest) < 1e-9


def check(rows, texts):
    """Pieces cover every id once, in order, without gaps inside a sequence."""
    encoder = packing.WordTokens(PATH, 2)
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        docs.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    for doc_id, copies in texts.items():
        want = library_ids(encoder, copies[0])
        own = sorted(docs[doc_id], key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == len(copies) * len(want) // 4
        assert all(bytes(p["ids"]) == want[4 * p["start"] : 4 * (p["start"] + p["length"])] for p in own)
        assert {p["doc_tokens"] for p in own} == {len(want) // 4}
    lengths = [sum(p["length"] for p in s) for s in sequences.values()]
    return sum(map(padding, lengths)), sum(lengths)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pad, total = check(
        packing.pack(docs, packing.word_tokens(PATH), block=1 << 14).collect(),
        {r["doc_id"]: [r["text"]] for r in docs.collect()},
    )
    assert pad <= 0.01 * total  # whole sentences are worth some padding


def test_awkward_tables(spark):
    docs = with_clashes(awkward_docs(spark)).where("doc_id is not null")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    check(packing.pack(docs, packing.word_tokens(PATH)).collect(), texts)
    nulls = packing.pack(awkward_docs(spark).where("doc_id is null"), packing.word_tokens(PATH)).collect()
    assert sum(p["length"] for p in nulls) > 1 and {p["doc_id"] for p in nulls} == {None}
    assert packing.pack(empty_docs(spark), packing.word_tokens(PATH)).count() == 0


def test_cuts_fall_at_sentence_ends(spark, sf):
    """Fewer than 2 % of the cuts are inside sentences, and padding is below 1 %.

    The powers of two that an input partition's last tokens are split into have no choice.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = packing.pack(docs, packing.word_tokens(path)).drop("ids").collect()
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    encoder = packing.WordTokens(path, 2)
    inside, cuts = 0, 0
    for r in rows:
        end = r["start"] + r["length"]
        ends_sequence = r["offset"] + r["length"] == used[r["sequence_id"]]
        if ends_sequence and (used[r["sequence_id"]] == 4096 or used[r["sequence_id"]].bit_count() > 1):
            cuts += 1
            if end < r["doc_tokens"]:
                _, sizes, stops = next(encoder.encode([texts[r["doc_id"]] or ""]))
                inside += end not in set(sizes.cumsum()[stops].tolist())
    padding = sum(4096 - n for n in used.values() if n.bit_count() > 1)
    assert cuts > 100 and inside < 0.02 * cuts and padding < 0.01 * sum(used.values())


def test_a_piece_in_use_is_encoded_once():
    """However it is cased and punctuated, while other pieces come and go; kept pieces are bounded."""
    encoder = packing.WordTokens(PATH, 2, remember=400)
    given, plain = Counter(), encoder.tokenizer

    class Counted:
        def encode(self, text, **options):
            given.update(text.split())
            return plain.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            given.update(p for t in texts for p in t.split())
            return plain.encode_batch_fast(texts, **options)

    name = lambda k: "".join("abcdefghij"[int(d)] for d in f"{k:05}")
    steady = [name(k) for k in range(110)]
    encoder.tokenizer = Counted()
    for turn in range(20):
        passing = [name(1000 + 20 * turn + k) for k in range(20)]
        forms = [w.upper() + "," if (k + turn) % 2 else f'"{w}."' for k, w in enumerate([*steady, *passing])]
        texts = [" ".join(forms[::2]), " ".join(forms[1::2])]
        got = [raw for raw, _, _ in encoder.encode(texts)]
        assert [g[:-4] for g in got] == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert max(given[w] for w in steady) == 1
    assert len(encoder.known) + len(encoder.former) <= 400 + 140
