"""Prefix trie of conversations by vertical bitmaps: members, children, leaves and savings of every node.

A turn travels as the MD5 of its role and text and its length; texts stay where they are. Turns are dealt out
by ranges of conversation ids, and each task cuts its range into *blocks* of at most ``BLOCK`` conversations.
In a block every (position, turn) has a posting: an integer whose bits are the conversations that have that
turn there. A depth-first walk from the bitset of all conversations intersects the parent's bitset with the
posting of the lowest conversation not yet placed: that is one child, its popcount the members in the block,
and the conversations that have no further turn are the node's end list.

Blocks hold disjoint ranges of ids, so a node's end list is the end lists of its blocks one after the other,
and its smallest member lies in exactly one block, its *owner*. Sums over a subtree add up over blocks when
each node counts in its owner only: nodes that stand in several blocks are looked up once (``lookup_join``:
broadcast if small, else the heaviest nodes apart), each block sums its own part of every subtree backwards
along its walk, and the parts are added up per node. A hot turn has one row a block, whatever its number of
conversations. The digest of an end list is worked out by a task that reads its blocks in order and keeps
only the state of the hash.

Size: a block holds at most ``BLOCK`` conversations, and closes at ``BLOCK_TURNS`` turns; one conversation is
never cut. A turn is 60 bytes or so on its way, independent of its text.

Defined results: turns are ordered by turn (null first), then by digest, so ties and repeated rows have one
order and each row is a turn; null role or text is empty. Rows with a null conv_id belong to no conversation
and are left out. Other columns are ignored. An empty table has no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelab.operators.lookup import lookup_join
from issuelab.session import stage

#: Conversations and turns of a block.
BLOCK = 4096
BLOCK_TURNS = 1 << 17

_WALK = (
    "block bigint, row int, up int, depth bigint, key string, n bigint, first bigint, chars bigint, kids bigint, "
    "ends array<bigint>"
)
_PART = (
    "block bigint, key string, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends array<bigint>"
)
_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``turn_key`` and ``chars`` of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.col("turn"), key.alias("turn_key"), F.length(text).cast("bigint").alias("chars")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_key")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("place"), "turn_key", "chars")


def rebuilt(turns: DataFrame, step: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first ``h = crc32(id) % most`` turns come from conversation ``id - id % step``.

    ``%`` keeps the sign, as in SQL. Takes and gives rows of ``turn_rows``; each conversation also has a row of place 0 without a key, so that
    one left without turns is still there. At most ``most - 1`` turns are lent, to ``step`` ids at most.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = turns.where("place = 1").select("conv_id")
    marks = ids.select(
        "conv_id", F.lit(0).cast("bigint").alias("place"), F.lit(None).cast("string").alias("turn_key"), F.lit(0).cast("bigint").alias("chars")
    )
    lenders = turns.where((F.col("conv_id") % step == 0) & (F.col("place") < most))
    lenders = lenders.withColumnRenamed("conv_id", "lender")
    wants = ids.withColumn("h", taken).where("h > 0").withColumn("lender", F.col("conv_id") - F.col("conv_id") % step)
    lent = wants.join(lenders, "lender").where("place <= h").select("conv_id", "place", "turn_key", "chars")
    return marks.unionByName(lent).unionByName(turns.where(F.col("place") > taken))


def _walk(block: list[tuple[int, list]]) -> list[tuple]:
    """Nodes of a block's trie in depth-first order. ``block`` holds (id, [(turn key, chars)]), ids ascending."""
    import hashlib

    ids = [i for i, _ in block]
    postings: list[dict] = []
    ends_at: dict[int, int] = {}
    for bit, (_, turns) in enumerate(block):
        mask = 1 << bit
        while len(postings) < len(turns):
            postings.append({})
        for at, (key, _) in enumerate(turns):
            postings[at][key] = postings[at].get(key, 0) | mask
        ends_at[len(turns)] = ends_at.get(len(turns), 0) | mask
    out: list[tuple] = []
    todo = [((1 << len(block)) - 1, 0, "", -1, 0)]
    while todo:
        bits, depth, key, up, chars = todo.pop()
        ended = bits & ends_at.get(depth, 0)
        rest, children = bits ^ ended, []
        while rest:
            turn_key, size = block[(rest & -rest).bit_length() - 1][1][depth]
            child = bits & postings[depth][turn_key]
            rest &= ~child
            children.append((child, depth + 1, hashlib.md5((key + turn_key).encode()).hexdigest(), len(out), size))
        first = ids[(bits & -bits).bit_length() - 1]
        ends = []
        while ended:
            low = ended & -ended
            ends.append(ids[low.bit_length() - 1])
            ended ^= low
        out.append((ids[0], len(out), up, depth, key, bits.bit_count(), first, chars, len(children), ends))
        todo.extend(reversed(children))
    return out


def _walked(schema, most: int, most_turns: int):
    """A task's turns (sorted by conversation and place) to the nodes of its blocks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        block: list[tuple[int, list]] = []
        held = 0
        for batch in batches:
            for conv_id, key, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn_key", "chars"))):
                if not block or block[-1][0] != conv_id:
                    if len(block) >= most or held >= most_turns:
                        yield table(_walk(block))
                        block, held = [], 0
                    block.append((conv_id, []))
                if key is not None:
                    block[-1][1].append((key, chars))
                    held += 1
        if block:
            yield table(_walk(block))

    return run


def _summed(schema):
    """Sums over subtrees, of what a block owns. One block at a time."""

    def run(table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["row"])
        for r in rows:
            r["owned"] = r["conv_id"] == r["first"]
            r["n_children"] = 0
            r["n_leaves"] = int(r["owned"] and not r["has_kids"])
            r["saved_tokens"] = (r["n_convs"] - 1) * r["chars"] if r["owned"] else 0
            r["parent_conv_id"] = rows[r["up"]]["conv_id"] if r["up"] >= 0 else None
        for r in reversed(rows):
            if r["up"] >= 0:
                above = rows[r["up"]]
                above["n_children"] += r["owned"]
                above["n_leaves"] += r["n_leaves"]
                above["saved_tokens"] += r["saved_tokens"]
        return pa.table([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)

    return run


def _closed(schema):
    """Parts of nodes (sorted by key and block) to nodes, with the digest of all ends."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        def finish(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        key, node, digest, any_end = None, None, None, False
        done: list[list] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (
                "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"
            ))
            for own, *values, ends in zip(*columns):
                if own != key:
                    if node:
                        done.append([*node, digest.hexdigest()])
                    key, node, digest, any_end = own, values, hashlib.sha256(), False
                else:
                    for at in (4, 5, 6):
                        node[at] += values[at]
                if ends:
                    digest.update(("," * any_end + ",".join(map(str, ends))).encode())
                    any_end = True
            if len(done) >= 10_000:
                yield finish(done)
                done = []
        if node:
            done.append([*node, digest.hexdigest()])
        if done:
            yield finish(done)

    return run


def trie(turns: DataFrame, block: int = BLOCK, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (rows of ``turn_rows`` or ``rebuilt``)."""
    spark = turns.sparkSession
    arrow = lambda ddl: _arrow_schema(spark, ddl)
    dealt = turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "place")
    walked = stage(dealt.mapInArrow(_walked(arrow(_WALK), block, block_turns), _WALK), "trie")
    totals = walked.groupBy("key").agg(
        F.count("*").alias("blocks"), F.sum("n").alias("all_n"), F.min("first").alias("all_first"), F.max("kids").alias("all_kids")
    )
    shared = totals.where("blocks > 1")
    known = lookup_join(walked, shared, "key", weight="blocks", spread_by=["block", "row"])
    either = lambda wide, own: F.coalesce(F.col(wide), F.col(own))
    known = known.select(
        *walked.columns,
        either("all_n", "n").alias("n_convs"),
        either("all_first", "first").alias("conv_id"),
        (either("all_kids", "kids") > 0).alias("has_kids"),
    )
    parts = known.groupBy("block").applyInArrow(_summed(arrow(_PART)), _PART)
    in_order = parts.repartition("key").sortWithinPartitions("key", "block")
    return in_order.mapInArrow(_closed(arrow(_NODE)), _NODE)


def _arrow_schema(spark, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression in DuckDB."""
    bits = "lambda c, k: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), {bits})"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(({text})[i])::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {byte}), 4294967295)"


def trie_sql(step: int = 100, most: int = 6) -> str:
    """The nodes of ``trie(rebuilt(turn_rows(conversations)))`` in DuckDB."""
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         md5(length(COALESCE(role, ''))::VARCHAR || ':' || COALESCE(role, '') || COALESCE(text, '')) AS turn_key
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {most} AS h,
         list(turn_key || ':' || length(text)::VARCHAR ORDER BY turn NULLS FIRST, turn_key) AS turns
  FROM keyed GROUP BY conv_id
), paths AS (
  SELECT c.conv_id, list_concat(list_slice(COALESCE(d.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS path
  FROM own c LEFT JOIN own d ON d.conv_id = c.conv_id - c.conv_id % {step}
), member AS (
  SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths
), nodes AS (
  SELECT depth, list_slice(path, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '')) AS ends_sha256
  FROM member GROUP BY ALL
), children AS (
  SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), sized AS (
  SELECT n.*, COALESCE(c.n, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * split_part(n.prefix[-1], ':', 2)::BIGINT END AS saved
  FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix
), below AS (
  SELECT list_slice(prefix, 1, above) AS prefix, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS above FROM sized) GROUP BY ALL
)
SELECT s.conv_id, s.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN below b ON b.prefix = s.prefix
LEFT JOIN nodes p ON s.depth > 0 AND p.prefix = list_slice(s.prefix, 1, s.depth - 1)
"""
