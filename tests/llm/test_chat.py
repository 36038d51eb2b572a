"""The prefix tree: what is read back, and the layout."""

import hashlib
import random

from issuelab.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, path string"


def build(spark, rows):
    return chat.build_tree(spark.createDataFrame([(*r, "mine", None) for r in rows], SCHEMA))


def make_rows():
    rng = random.Random(4)
    texts = ["hi", "</s>[INST] ok [/INST]", "a\\<|end|>\\", "<|turn|>x<|text|>", "<<SYS>>é\U0001f642\n", None, "", "<", "\\"]
    rows = []
    for c in range(60):
        start = c % 3
        for t in range(rng.randint(1, 7)):
            text = texts[start] if t == 0 else rng.choice(texts)
            rows.append((c, t, rng.choice(["user", "assistant", "system\n", None]) if t else "user", text))
    rows += [(1000 + k, t, r, x) for k in range(20) for c, t, r, x in rows if c == 5]  # copies
    return rows + [(None, None, None, None), (None, 1, "assistant", "end"), (7, 0, "user", "hi")]


def test_round_trip_and_layout(spark):
    rows = make_rows()
    tree = build(spark, rows)
    want = {}
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r[1:])
    for r in sorted(rows, key=key):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    got = {r["conv_id"]: r for r in chat.read_back(tree).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["learned"] == "".join(x for role, x in turns if role == "assistant")
    blocks = tree.blocks.orderBy("flat_start", "length").collect()
    flat = "".join(b["text"] for b in blocks)
    distinct = {tuple(v) for v in want.values()}
    nodes = {v[:k] for v in distinct for k in range(1, len(v) + 1)}
    assert len(blocks) == len(distinct)
    assert flat.count(chat.TURN) == len(nodes)  # every shared turn once
    whole = {r["block"]: got[r["conv_id"]]["formatted"] for r in tree.members.collect()}
    for b in blocks:
        assert flat[b["flat_start"] : b["flat_start"] + b["length"]] == b["text"]
        before = "".join(flat[a["start"] : a["end"]] for a in b["attention"])
        assert len(before) == b["position_start"] and before + b["text"] == whole[b["block"]]
        assert all(x["end"] < y["start"] or x["end"] > y["start"] for x, y in zip(b["attention"], b["attention"][1:]))


def test_empty(spark):
    tree = build(spark, [])
    assert tree.blocks.count() == 0 and chat.read_back(tree).count() == 0


def test_many_turns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(400)]
    rows += [(2, *r[1:]) if r[1] < 399 else (2, 399, "user", "other") for r in rows]
    got = {r["conv_id"]: r for r in chat.read_back(build(spark, rows)).collect()}
    digest = lambda c: hashlib.sha256("".join(f"{t['role']}\n{t['text']}\n" for t in got[c]["turns"]).encode()).hexdigest()
    plain = lambda c: hashlib.sha256("".join(f"{r}\n{x}\n" for i, _, r, x in rows if i == c).encode()).hexdigest()
    assert digest(1) == plain(1) and digest(2) == plain(2)
