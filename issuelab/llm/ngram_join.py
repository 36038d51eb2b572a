"""N-gram Jaccard join by T-occurrence search, and the groups that its links form.

A text's set is its distinct shingles of ``width`` words. Two sets of sizes n <= m link when
100 * overlap >= ``percent`` * union, which needs an overlap of at least T(m) = ceil(percent * m / 100).

Index. Shingles are ordered by their hash. Each set is indexed under its first E = n - T(n) + l(n)
shingles. The smallest l(n) common shingles of a linked pair stand in both prefixes, so of the inverted
lists of the smaller set's prefix at least l(n) hold the larger set.

Search (DivideSkip). Of its E lists a set leaves out the l(n) - 1 longest and merges the others, the short
ones: every partner is in at least one of these. The merge runs over the whole cluster at once, as a join of
the short lists and a count per pair. Candidates are then probed by binary search with the whole sets, the
long lists included, which gives the exact overlap.

Groups. Equal sets are one node. As only groups are wanted, pairs that are known to be in one group need
no search: first each set is compared to the first set of most of its lists (one pair a set), and blocks of
sets that share a shingle are searched in one task each; then lists within one of the groups found so count
as empty, and only pairs across groups are searched, by prefixes of
``LONGER`` times as many lists as must be merged. So a large family of copies costs a pair for each copy,
sets that share long passages are searched by what else they hold, and no link between groups is missed.
There all sets order their lists alike, empty ones first, then the shortest, and a pair must meet early in both
orders: so neither set brings its long lists, those of a family for example, unless it has no others.
Pairs whose parity sketches already differ in more places than a link allows are not formed. Lists of the same
sets count as one there, so sets that share a long passage are paired once and not at each of its shingles.

Shingles, and sets, are told apart by 64-bit hashes. Defined results: null texts, and texts without words,
have an empty set, link with nothing and are their own component. Fewer than ``width`` words are one
shingle. Repeated rows and equal texts share a component. Rows with a null doc_id take part; a component's
id is its smallest doc_id that isn't null. Columns named like a result column are replaced. An empty table
stays empty. Very long texts are split into words one text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from issuelab.llm.common import bounded_batches, release_memory, spare_name, text_of
from issuelab.llm.components import connected
from issuelab.operators.lookup import fits_broadcast, lookup_join
from issuelab.session import stage


#: Nodes that a broadcast of node ids may hold, measured before it is made.
MAX_BROADCAST_NODES = 1_000_000
#: Length of the longer prefixes, as a multiple of the lists that must be merged.
LONGER = 4


@dataclass(frozen=True)
class Join:
    """Shingle width in words, and the similarity that links, in percent."""

    width: int = 4
    percent: int = 85

    def least_overlap(self, n):
        return (self.percent * n + 99) // 100

    def short_lists(self, n):
        """How many lists of a set of n must be merged."""
        return n - self.least_overlap(n) + 1

    def spare(self, n):
        """l(n): how many lists of the prefix are sure to hold a partner."""
        return (self.short_lists(n) + 1) // 2

    def prefix(self, n):
        return self.short_lists(n) + self.spare(n) - 1


_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Shingler:
    """Sorted distinct shingle hashes of texts; hashes of words are remembered."""

    def __init__(self, join: Join, remember: int = 200_000):
        import xxhash

        self.width, self.remember, self.digest = join.width, remember, xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}
        rng = np.random.default_rng(2024)
        self.factors = rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and white space only
        if not words:
            return np.zeros(0, np.int64)
        known, digest = self.words, self.digest
        if len(known) > self.remember:
            known.clear()
        hashes = np.fromiter([known.get(w) or known.setdefault(w, digest(w)) for w in words], np.uint64, len(words))
        span = min(self.width, len(words))
        n = len(words) - span + 1
        with np.errstate(over="ignore"):
            total = np.full(n, span, np.uint64) * np.uint64(_MIX[0])
            for k in range(span):
                total += hashes[k : k + n] * self.factors[k]
            total ^= total >> np.uint64(30)
            total *= np.uint64(_MIX[1])
            total ^= total >> np.uint64(27)
            total *= np.uint64(_MIX[2])
            total ^= total >> np.uint64(31)
        return np.unique(total.view(np.int64))


def _node(shingles: np.ndarray) -> int | None:
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


#: Words of the parity sketch. Bit k is the parity of the shingles that hash to k, so the bits in which two
#: sketches differ are at most as many as the shingles that only one of the sets has.
SKETCH = tuple(f"s{k}" for k in range(16))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    bits = np.bincount((shingles >> 17) & (64 * len(SKETCH) - 1), minlength=64 * len(SKETCH)) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _signed_type(sketched: bool) -> StructType:
    signed = StructType().add("node", LongType()).add("n", LongType()).add("part", ArrayType(LongType()))
    for word in SKETCH if sketched else ():
        signed.add(word, LongType())
    return signed


def _signed(join: Join, whole: bool) -> Column:
    """Column function: text to node, size, and the whole set with its sketch, or its indexed prefix.

    A task leaves out the prefix of a node that it has met already; copies add nothing to the index.
    """

    @F.arrow_udf(_signed_type(whole))
    def sign(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingle, met = Shingler(join), set()
        for texts in parts:
            sets, nodes, sizes, sketches = [], [], [], []
            for text in texts.to_pylist():
                s = shingle(text)
                node = _node(s)
                nodes.append(node)
                sizes.append(len(s))
                if whole:
                    sketches.append(_sketch(s))
                else:
                    s = s[:0] if node in met else s[: join.prefix(len(s))]
                    if len(met) < 200_000:
                        met.add(node)
                sets.append(s)
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(sets)]
            if whole:
                words = np.array(sketches, np.int64).reshape(-1, len(SKETCH)).T
                columns += [pa.array(np.ascontiguousarray(w)) for w in words]
            yield pa.StructArray.from_arrays(columns, names=_signed_type(whole).names)
        met.clear()
        release_memory()

    return sign


def _with_sets(docs: DataFrame, join: Join, whole: bool, text: str) -> DataFrame:
    return docs.withColumn("_s", _signed(join, whole)(text_of(text)))


@F.arrow_udf(LongType())
def _overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    """Size of the intersection of sorted sets: the shorter one's members are probed in the longer one."""
    out = np.zeros(len(left), np.int64)
    a, b = (x.values.to_numpy(zero_copy_only=False) for x in (left, right))
    ends = zip(*(x.offsets.to_numpy() for x in (left, right)))
    p, q = next(ends)
    for k, (p2, q2) in enumerate(ends):
        few, many = sorted((a[p:p2], b[q:q2]), key=len)
        at = np.searchsorted(many, few)
        out[k] = np.count_nonzero(many[np.minimum(at, len(many) - 1)] == few) if len(many) else 0
        p, q = p2, q2
    return pa.array(out)


def _verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of ``pairs`` (a, b) that link."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("part").alias(f"s_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("o", _overlap("s_a", "s_b"))
    return both.where(100 * F.col("o") >= join.percent * (F.col("n_a") + F.col("n_b") - F.col("o"))).select("a", "b")


def _sizes_fit(join: Join, small: str, large: str) -> Column:
    return join.percent * F.col(large) <= 100 * F.col(small)


def links(docs: DataFrame, signed: DataFrame, join: Join, text: str = "text") -> DataFrame:
    """Links (a, b) between nodes that connect all nodes which any links connect."""
    postings = signed.select("node", "n", F.explode("part").alias("h"))
    lists = postings.groupBy("h").agg(
        F.count("*").alias("df"), F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("last")
    )
    lists = lists.where(F.col("hub.node") != F.col("last")).select("h", "df", "hub")
    shared = postings.join(lists, "h").dropDuplicates(["h", "node"])
    shared = stage(shared, "shared")

    # Sets with too few shared shingles for any partner, the smallest one allowed included, drop out here.
    alive = shared.groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("met"))
    alive = stage(alive.where(F.col("met") >= _spare_of_smallest(join)).select("node", "n"), "alive")
    small = fits_broadcast(alive, MAX_BROADCAST_NODES)
    chosen = F.broadcast(alive.select("node")) if small else alive.select("node")
    shared = stage(shared.join(chosen, "node", "left_semi"), "searched")
    # Of the rows of a node one id's are read again. Ids may be null or repeated: what else they bring is left out.
    firsts = signed.join(chosen, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("first")).select("first")
    read = docs.join(F.broadcast(firsts) if small else firsts, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    sets = _with_sets(read, join, True, text).select("_s.*").join(chosen, "node", "left_semi")
    sets = stage(sets.dropDuplicates(["node"]), "sets")

    # First pass: the first set of most lists.
    hubs = shared.where(F.col("hub.node") != F.col("node")).groupBy("node", "hub").agg(F.count("*").alias("c"))
    fits = (join.percent * F.greatest("n", "hub.n") <= 100 * F.least("n", "hub.n"))
    hubs = hubs.join(alive.select("node", "n"), "node").where(fits)
    best = hubs.groupBy("node").agg(F.max(F.struct("c", "hub")).alias("best"))
    pairs = best.select(F.col("node").alias("a"), F.col("best.hub.node").alias("b"))
    first = stage(_verified(pairs, sets, join), "links")
    groups = stage(connected(first), "groups")

    # Then blocks of sets that share a shingle are searched, each in one task.
    grouped = stage(_across(shared.drop("hub", "df"), groups, join), "grouped")
    blocks = stage(_searched_blocks(grouped, sets, join), "blocks")
    first = first.unionByName(blocks)
    groups = stage(connected(first), "groups")

    # Second pass: only sets with enough lists across groups, under longer prefixes, so that even sets made
    # up of common passages for the most part have rare shingles to be searched by.
    rest = _across(grouped.drop("root"), groups, join).select("node", "root").distinct()
    longer, merged, asking = (F.expr(e) for e in _early(join))
    postings = sets.join(rest, "node").select("node", "n", "root", F.explode(F.slice("part", F.lit(1), longer.cast("int"))).alias("h"))
    lists = postings.groupBy("h").agg(
        F.count("*").alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("l")
    )
    across = postings.join(lists.where("lo <> hi").select("h", "df", "l"), "h")
    # Lists that are the set's own, or within its group, come first and for free. All sets order the others alike.
    by_length = Window.partitionBy("node").orderBy("df", "l", "h")
    placed = across.withColumn("place", F.row_number().over(by_length)).withColumn(
        "mixed", F.count("*").over(Window.partitionBy("node"))
    ).withColumn("place", F.col("place") + longer - F.col("mixed"))
    early = placed.where(F.col("place") <= merged).groupBy("node", "l").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.min("place").alias("place")
    )
    early = stage(early.join(sets.select("node", *SKETCH), "node"), "early")
    asked = early.where(F.col("place") <= asking)
    second = _verified(_candidates(asked, early, join).select("a", "b").distinct(), sets, join)
    return first.unionByName(second)


def _early(join: Join) -> tuple[str, str, str]:
    """SQL for a set of ``n``: its longer prefix, and the first places of its order of lists in which it meets a partner:
    any partner, and one that is not smaller.

    Of two linked sets' prefixes, with L(n) and L(m) lists and an overlap of O, the one that ends first lies in what the
    other prefix covers, so they share s = min(L(n) - (n - O), L(m) - (m - O)) lists at least. The first of these in the
    common order stands behind L(n) - s lists at most. For partners that are not smaller this is greatest for the
    smallest or the largest one, but for rounding, which ``LONGER`` covers.
    """
    p = join.percent
    short = lambda n: f"({n} - ({p} * {n} + 99) div 100 + 1)"
    longer = lambda n: f"least({n}, {LONGER} * {short(n)})"
    overlap = lambda n, m: f"(({p} * ({n} + {m}) + {99 + p}) div {100 + p})"
    most = f"(100 * n div {p})"
    behind = [f"n - {overlap('n', 'n')}", f"{longer('n')} - {longer(most)} + {most} - {overlap('n', most)}"]
    asking = f"least({short('n')}, greatest({behind[0]}, {behind[1]}) + 1 + {LONGER})"
    return longer("n"), f"{short('n')} + {LONGER}", asking


def _candidates(asked: DataFrame, across: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) of sets of two groups that may link: ``a`` asks for one of its lists and ``b`` is in it."""
    # The shingles of a passage have one list, that of the sets with the passage. Sets are paired once a list, by the
    # hash of its nodes; should two lists share a hash, their sets are paired too, and the probe decides.
    side = lambda df, x: df.dropDuplicates(["node", "l"]).select(
        "l", F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "root", *SKETCH)]
    )
    asked, other = side(asked, "a"), side(across, "b")
    later = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    # The least overlap of a linked pair is percent * (n_a + n_b) / (100 + percent), rounded up.
    least = f"(({join.percent} * (n_a + n_b) + {99 + join.percent}) div {100 + join.percent})"
    near = differ <= F.expr(f"n_a + n_b - 2 * {least}")
    fit = later & _sizes_fit(join, "n_a", "n_b") & near
    return asked.join(other, "l").where((F.col("root_a") != F.col("root_b")) & fit)


def _across(shared: DataFrame, groups: DataFrame, join: Join) -> DataFrame:
    """Postings in lists that hold several groups, of nodes that have enough of them for a partner."""
    grouped = shared.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    grouped = stage(grouped, "rooted")
    mixed = grouped.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
    kept = grouped.join(mixed, "h", "left_semi")
    enough = kept.groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("met"))
    enough = enough.where(F.col("met") >= _spare_of_smallest(join)).select("node")
    return kept.join(enough, "node", "left_semi")


#: Sets that a block holds about, and how many times sets are dealt into blocks.
BLOCK, DEALS = 256, 3


def _searched_blocks(grouped: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links found by searching blocks of sets that share their first shingle under a seeded order.

    A shingle with many sets is dealt into several blocks, so no task gets more than a block at once.
    """
    places = [F.min_by("h", F.xxhash64(F.lit(k), "h")) for k in range(DEALS)]
    dealt = grouped.groupBy("node").agg(F.first("root").alias("root"), F.array(*places).alias("keys"))
    dealt = dealt.select("node", "root", F.posexplode("keys").alias("deal", "key"))
    sizes = dealt.groupBy("deal", "key").agg(F.count("*").alias("c")).where("c > 1")
    dealt = dealt.join(sizes, ["deal", "key"])
    block = F.pmod(F.xxhash64("node", "deal"), F.ceil(F.col("c") / BLOCK)).cast("int")
    rows = dealt.select("deal", "key", block.alias("block"), "node", "root").join(sets, "node")

    def search(block: pa.Table) -> pa.Table:
        ids, roots = np.asarray(block["node"]), np.asarray(block["root"])
        parts = block["part"].combine_chunks()
        flat, ends = parts.values.to_numpy(zero_copy_only=False), parts.offsets.to_numpy()
        found = divide_skip([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], roots, join)
        a, b = ([ids[pair[k]] for pair in found] for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("deal", "key", "block").applyInArrow(search, "a bigint, b bigint")


def divide_skip(sets: list[np.ndarray], groups: np.ndarray, join: Join) -> list[tuple[int, int]]:
    """Links that connect the groups of some sets (sorted shingles); pairs already connected are passed over.

    Each set merges its shortest inverted lists, as many as any partner must share one of, and probes the
    candidates for the rest by binary search.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    by_token = owner[np.argsort(token, kind="stable")]
    starts = np.concatenate([[0], df.cumsum()])
    own = np.split(token, sizes.cumsum()[:-1])
    first: dict[int, int] = {}
    parent = [first.setdefault(g, k) for k, g in enumerate(groups.tolist())]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in np.argsort(sizes, kind="stable").tolist():
        n = len(sets[i])
        lengths = df[own[i]]
        short = own[i][np.argsort(lengths, kind="stable")[: join.short_lists(n)]]
        lists = [by_token[starts[t] : starts[t + 1]] for t in short.tolist() if df[t] > 1]
        if not lists:
            continue
        near = np.unique(np.concatenate(lists))
        near = near[(sizes[near] >= n) & (join.percent * sizes[near] <= 100 * n)]
        for j in near.tolist():
            if find(i) == find(j):
                continue
            at = np.searchsorted(sets[j], sets[i])
            overlap = np.count_nonzero(sets[j][np.minimum(at, len(sets[j]) - 1)] == sets[i])
            if 100 * overlap >= join.percent * (n + len(sets[j]) - overlap):
                links.append((i, j))
                parent[find(i)] = find(j)
    return links


def _spare_of_smallest(join: Join) -> Column:
    """l of the smallest partner that a set of ``n`` may have."""
    least = f"cast(ceil({join.percent} * n / 100) as bigint)"
    return F.expr(f"({least} - ({join.percent} * {least} + 99) div 100 + 2) div 2")


def _node_table(signed: DataFrame, docs: DataFrame, join: Join, text: str) -> DataFrame:
    """node, root (of its component), component_id, copies (rows), own_id, r (rows of the node with ``own_id``)."""
    nodes = signed.where("node is not null").groupBy("node", "doc_id").agg(F.count("*").alias("rows"))
    # Rows of the smallest id that isn't null; nodes without one have a single group, that of the null id.
    named = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows")))["rows"]
    nodes = nodes.groupBy("node").agg(
        F.min("doc_id").alias("own_id"), F.sum("rows").alias("copies"), F.coalesce(named, F.max("rows")).alias("r")
    )
    roots = stage(connected(links(docs, signed, join, text)), "components")
    ids = roots.join(nodes.select("node", "own_id"), "node").groupBy("root").agg(F.min("own_id").alias("component_id"))
    roots = roots.join(ids, "root").select("node", "root", "component_id")
    table = nodes.join(roots, "node", "left")
    root, component = F.coalesce("root", "node"), F.coalesce("component_id", "own_id")
    return table.select("node", root.alias("root"), component.alias("component_id"), "copies", "own_id", "r")


def with_components(docs: DataFrame, join: Join = Join(), text: str = "text") -> DataFrame:
    """``docs`` with ``n_shingles`` and ``component_id``."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = stage(_with_sets(narrow, join, False, "text").select("doc_id", "_s.node", "_s.n", "_s.part"), "signed")
    table = _node_table(signed, narrow, join, "text").drop("root", "own_id", "r")
    if set(docs.columns) <= {"doc_id", text}:
        rows = signed.select("doc_id", "n", "node")
        found = lookup_join(rows, table, "node", weight="copies", spread_by=("doc_id",))
        return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    own = docs.drop(*[c for c in docs.columns if c.lower() in ("n_shingles", "component_id")])
    key, copies = spare_name(own, "node"), spare_name(own, "copies")
    keyed = own.withColumn(key, _signed(join, False)(text_of(text)))
    keyed = keyed.withColumn("n_shingles", F.col(key)["n"]).withColumn(key, F.col(key)["node"])
    table = table.withColumnsRenamed({"node": key, "copies": copies})
    found = lookup_join(keyed, table, key, weight=copies, spread_by=("doc_id",))
    return found.withColumn("component_id", F.coalesce("component_id", "doc_id")).drop(key, copies)


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row of each component, that of the smallest doc_id; rows without words all stay."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stage(_with_sets(narrow, join, False, "text").select("doc_id", "_s.node", "_s.n", "_s.part"), "signed")
    table = _node_table(signed, narrow, join, "text")
    # The node that gives the component its id, and of its rows with that id only one. Components are told
    # apart by root: ids may be null or repeated.
    owners = table.where(F.col("own_id").eqNullSafe(F.col("component_id")))
    owners = owners.groupBy("root").agg(F.min(F.struct("node", "own_id", "r")).alias("first"))
    owners = owners.select("first.node", F.col("first.own_id").alias("keep_id"), F.col("first.r").alias("keep_rows"))
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    held = held.withColumn("node", _signed(join, False)(F.col("text"))["node"]).drop("text")
    found = lookup_join(held, owners, "node", weight="keep_rows", spread_by=("doc_id",))
    stays = F.col("node").isNull() | (F.col("keep_rows").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    found = found.where(stays)
    repeated = F.coalesce(F.col("keep_rows") > 1, F.lit(False))
    single = found.where(~repeated).select("row.*")
    return single.unionByName(found.where(repeated).dropDuplicates(["node"]).select("row.*"))
