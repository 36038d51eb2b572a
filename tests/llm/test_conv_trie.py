"""Conversation trie: nodes equal those of plain prefixes, whatever the blocks; awkward tables; SQL."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from issuelab.llm import conv_trie
from issuelab.operators import lookup

ROWS = "conv_id bigint, turn bigint, role string, text string"
FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows, step=100, most=6):
    """Nodes by prefixes of whole texts; ties in turn are not expected here."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        paths[c] = own.get(c - int(math.fmod(c, step)), [])[:h] + turns[h:]
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    out = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        has_child = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in sorted(inside) if tuple(paths[c]) == node)
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            sum(n[:-1] == node for n in members if n), sum(n not in has_child for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def nodes(df, *blocks):
    return sorted((tuple(r[f] for f in FIELDS) for r in conv_trie.trie(df, *blocks).collect()), key=str)


def made(seed=5, n=260):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        hot = rng.random() < 0.4  # copies of one conversation
        for turn in range(3 if hot else rng.randrange(1, 9)):
            rows.append((c, turn, "user" if turn % 2 else "assistant", "hot" if hot else rng.choice(["a", "bb", "é🙂", ""])))
    return rows


@pytest.mark.parametrize("blocks", [(), (1, 1), (7, 1 << 17), (4096, 9)])
def test_nodes_equal_plain_prefixes(spark, blocks):
    rows = made()
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert nodes(conv_trie.rebuilt(conv_trie.turn_rows(df)), *blocks) == plain(rows)


def test_shared_nodes_beyond_the_broadcast_size(spark, monkeypatch):
    rows = made(9)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_KEYS", 2)
    assert nodes(conv_trie.rebuilt(conv_trie.turn_rows(df)), 7) == plain(rows)


def test_awkward_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 1, None, None), (0, 2, "user", "x" * 100_000),
        (None, 0, "user", "nobody's"), (None, 1, "user", "nobody's"),
        (3, 5, "user", ""), (250, 0, "user", "lender is absent"), (-7, 0, "user", "negative"),
    ]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'mine' key", "1 place", "2 n", "'z' ends", "9L block")
    assert nodes(conv_trie.rebuilt(conv_trie.turn_rows(df))) == plain(rows)
    twice = conv_trie.turn_rows(df.unionByName(df))
    assert twice.count() == 12 and conv_trie.trie(conv_trie.turn_rows(df)).where("depth = 0").first()["n_convs"] == 4
    tied = [(1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b")]
    got = nodes(conv_trie.turn_rows(spark.createDataFrame(tied, ROWS)))
    assert [g[3] for g in got] == [2, 2, 2]  # one order, whatever the order of rows
    empty = spark.createDataFrame([], ROWS)
    assert conv_trie.trie(conv_trie.rebuilt(conv_trie.turn_rows(empty))).count() == 0


def test_only_turnless_conversations(spark):
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    got = nodes(conv_trie.rebuilt(conv_trie.turn_rows(spark.createDataFrame([(lost, 0, "user", "gone")], ROWS))))
    digest = hashlib.sha256(str(lost).encode()).hexdigest()
    assert got == [(lost, 0, None, 1, 0, 1, 0, digest)]


def test_sql_states_the_same(spark):
    rows = made(11, 120)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = con.execute(conv_trie.trie_sql())
    names = [c[0] for c in result.description]
    found = sorted((tuple(r[names.index(f)] for f in FIELDS) for r in result.fetchall()), key=str)
    assert found == plain(rows)


def test_deep_conversation(spark):
    rows = [(c, t, "user", str(t)) for c in (6, 7) for t in range(5000)] + [(7, 5000, "user", "more")]
    got = conv_trie.trie(conv_trie.turn_rows(spark.createDataFrame(rows, ROWS)))
    assert got.count() == 5002 and got.agg({"n_leaves": "max"}).first()[0] == 1
