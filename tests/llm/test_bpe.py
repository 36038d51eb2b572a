"""Merge replay against the reference tokenizer library, and the round trip."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from issuelab.llm import bpe

from .awkward import awkward_docs, empty_docs, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH, public_tokenizers.PATTERN)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_same_ids_as_the_library(library, encoder):
    rng = random.Random(3)
    parts = ["a", "B", "'s", "'LL", " ", "\n", "\x1c", "é", "aaaa", "hello", "ing", "1", "٣", "  ", " ", "　"]
    parts += ["​", "🙂", "漢字", "\x85", "\t", "abab", "=====", "0000", "\x00", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(chr(rng.randint(1, 0xD7FF)) for _ in range(rng.randint(0, 9))) for _ in range(1000)]
    assert encoder.encode(texts) == [packed(library.encode_ordinary(t)) for t in texts]


def test_merges_that_open_a_lower_rank_keep_the_order():
    merges = bpe.Merges(PATH)
    rng = random.Random(5)
    words = [bytes(rng.choice(b"abcetn ") for _ in range(rng.randint(1, 30))) for _ in range(800)]
    assert bpe.replay(words, merges) == [packed(merges.one_by_one(w)) for w in words]


def test_long_texts_are_read_in_segments(library):
    small = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    small.SEGMENT = 40
    text = "Some words, and 12 more (words) of\n a long  text. " * 50
    assert small.encode([text, "x", text]) == [packed(library.encode_ordinary(t)) for t in (text, "x", text)]


def test_table(spark, library):
    docs = with_clashes(awkward_docs(spark))
    back = bpe.decoded(bpe.encoded(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert len(back.columns) == len({c.lower() for c in back.columns})
    for r in back.select("text", "ids", "n_tokens", "decoded").collect():
        want = library.encode_ordinary(r["text"] or "")
        assert (bytes(r["ids"]), r["n_tokens"]) == (packed(want), len(want))
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.encoded(empty_docs(spark), PATH, public_tokenizers.PATTERN).count() == 0
