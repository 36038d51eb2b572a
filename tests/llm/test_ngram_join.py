"""The Jaccard join against all pairs, with families of copies, shared passages and tiny texts."""

import random
import re

import pytest

from issuelab.llm import ngram_join
from issuelab.llm.components import connected
from issuelab.llm.ngram_join import Join

from .awkward import awkward_docs, empty_docs, with_clashes


def shingles(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, join):
    """(id, set size, smallest id reachable) by comparing all pairs."""
    sets = [(i, shingles(t, join.width)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= join.percent * len(s | t):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k][1]), smallest[find(k)]) for k in range(len(rows))), key=str)


def make_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(rng.randint(3, 120))] for _ in range(25)]
    rows = []
    for b in bases:
        for _ in range(rng.choice([1, 1, 2, 12])):
            w = list(b)
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[word()], [], [w[k].upper(), word()]])
            if rng.random() < 0.4:
                w = w + passage if rng.random() < 0.5 else passage + w
            rows.append(" ".join(w))
    chain = [str(k) for k in range(60)]
    rows += [" ".join(chain[k : k + 40]) for k in range(0, 12, 2)]  # each links with the next only
    rows += [" ".join(["is", "onhe."] * n) for n in (1, 2, 3, 10)] + ["a b c", "A b  c", "a b c d", "", " \n", None]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(3, rows[3]), (None, rows[5]), (None, None)]


@pytest.mark.parametrize("seed,join", [(1, Join()), (2, Join(5, 80)), (3, Join(2, 60)), (4, Join(4, 100))])
def test_same_groups_as_all_pairs(spark, seed, join):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in ngram_join.with_components(df, join).collect()), key=str)
    assert got == brute(rows, join)
    kept = ngram_join.keep_one(df, join).collect()
    want = [r for r in brute(rows, join)]
    assert sorted({r["doc_id"] for r in kept if shingles(r["text"], join.width)}) == sorted({c for _, n, c in want if n})
    assert len(kept) == len({c for _, n, c in want if n}) + sum(n == 0 for _, n, _ in want)


def test_one_large_family(spark):
    base = " ".join(f"w{k}" for k in range(80))
    rows = [(k, base.replace(f"w{k % 80} ", f"x{k} ", 1)) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = ngram_join.with_components(df).collect()
    assert len(got) == 3000 and {r["component_id"] for r in got} == {0}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5), (9, 8)]
    got = dict(tuple(r) for r in connected(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1400)}}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_tables(spark):
    docs = with_clashes(awkward_docs(spark))
    got = ngram_join.with_components(docs)
    assert got.count() == docs.count() and set(got.columns) == set(docs.columns)
    assert {r["component_id"] for r in got.where("doc_id in (5, 6)").collect()} == {5}
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (1, 5, 6)").count() == 2
    assert ngram_join.with_components(empty_docs(spark)).count() == 0
    assert ngram_join.keep_one(empty_docs(spark)).count() == 0


def test_components_without_an_id_of_their_own_keep_a_row_each(spark):
    rows = [(None, f"text {k} has words of its own {k * k}") for k in range(5)]  # no links, no ids
    rows += [(None, rows[0][1]), (None, "a b c d e f g h"), (4, "A b c d e f g h"), (4, "A b c d e f g h")]
    rows += [(9, "one id stands here twice"), (9, "with another text the second time"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.keep_one(df).collect()), key=str)
    assert kept == sorted([*rows[:5], rows[7], *rows[9:]], key=str)


def test_a_shared_passage_pairs_its_sets_once(spark):
    """Shingles with the same list give one row a pair, and lists that only one of them asks for are still met."""
    sketch = dict.fromkeys(ngram_join.SKETCH, 0)
    post = lambda node, lists: [{"node": node, "n": 100, "root": node, "h": h, "l": l, **sketch} for h, l in lists]
    passage = [(h, 7) for h in range(60)]
    across = spark.createDataFrame(post(1, passage) + post(2, [*passage, (90, 8)]) + post(3, [(90, 8)]))
    asked = across.where("h >= 30")
    rows = ngram_join._candidates(asked, across, Join()).select("a", "b").collect()
    assert sorted(map(tuple, rows)) == [(1, 2), (2, 3)]


def test_only_one_row_of_a_searched_set_is_read_again(spark, monkeypatch):
    """Texts that share nothing, and further copies, are not split into shingles a second time; ids may repeat."""
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    near = text(60)
    rows = [(k, text(60)) for k in range(100, 140)] + [(k, near) for k in range(30)] + [(None, near + " end"), (100, near + " fin")]
    read, plain = [], ngram_join._with_sets

    def counted(docs, join, whole, text):
        read.extend([docs.count()] if whole else [])
        return plain(docs, join, whole, text)

    monkeypatch.setattr(ngram_join, "_with_sets", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.with_components(docs, Join()).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, Join())))
    assert read and read[0] <= 4


@pytest.mark.parametrize("percent", [34, 60, 80, 85, 93, 100])
def test_linked_sets_meet_in_the_places_that_they_bring(spark, percent):
    """The worst place of the first shared list, for each two sizes that may link, lies within the bounds."""
    join, top = Join(4, percent), 900
    names = [f"{e} as c{k}" for k, e in enumerate(ngram_join._early(join))]
    table = spark.range(1, 100 * top // percent + 2).selectExpr("id as n").selectExpr("n", *names).orderBy("n").collect()
    longer, met, asked = ([None, *(r[f"c{k}"] for r in table)] for k in range(3))
    for n in range(1, top):
        for m in range(n, 100 * n // percent + 1):
            overlap = -(-percent * (n + m) // (100 + percent))
            shared = min(longer[n] - (n - overlap), longer[m] - (m - overlap))
            assert longer[n] - shared + 1 <= asked[n] and longer[m] - shared + 1 <= met[m], (n, m)


def test_near_families_are_paired_by_their_rare_lists(spark, monkeypatch):
    """Copies of a text that are just too far from each other to link bring few lists, and few pairs."""
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(20):
        w = list(base)
        for at in range(4 * k, 400, 80):
            w[at] = f"x{k}y{at}"
        rows.append((k, " ".join(w)))
    made, plain = [], ngram_join._candidates

    def counted(asked, other, join):
        pairs = plain(asked, other, join)
        made.append((asked.count(), other.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.with_components(docs, Join()).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, Join())
    (asked, other, pairs), = made
    assert 0 < asked <= other <= 20 * 64 and pairs <= 190, made
