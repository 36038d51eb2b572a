"""Chat formatting as a prefix tree: turns that conversations share are emitted once.

Conversations are paths of turns. Sorted by path, the tree comes out depth-first: each distinct
conversation emits one *block*, the turns that the one before it does not share. A block has its place in
the flat sequence of all tokens, the position id of its first token (tokens on its path before it) and the
intervals of the flat sequence that hold its ancestors; a token attends to these and to its block up to
itself. Tokens are code points of the formatted text.

The template is ``<|turn|>role<|text|>text<|end|>`` for each turn. In roles and texts a backslash follows
the first character of every control string and every backslash, so no control string is left inside, and
dropping each such backslash gives the text back.

Size: one conversation is one row and must fit in a task. Any number of conversations may share a turn or
be copies: copies are made one before the sort, which is by range over whole paths, and ancestors are
found by a join over prefixes, not by gathering a tree.

Defined results: null text or role is empty. Turns are ordered by turn, then role, then text, nulls first;
repeated rows are turns of their own. Rows with a null conv_id are one conversation. Other columns are
ignored. An empty table gives empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelab.llm.common import bind
from issuelab.session import stage

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: First characters of control strings, by what follows them; and the backslash.
_CONTROL = r"(\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


@dataclass(frozen=True)
class Tree:
    """``blocks``: one row per distinct conversation in depth-first order; ``members``: conversation to block."""

    blocks: DataFrame
    members: DataFrame


def _paths(conversations: DataFrame) -> DataFrame:
    """One row per conversation: formatted turns, their lengths and their chained keys."""
    turn = F.struct("turn", "role", "text")
    rows = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
            escape(t["text"]).alias("body"),
            t["role"].eqNullSafe(F.lit(LEARNED_ROLE)).alias("learned"),
        ),
    )
    rows = rows.select("conv_id", formatted.alias("turns"))
    keys = F.transform("turns", lambda t: F.md5(F.concat(t["head"], t["body"])))
    rows = rows.withColumn("path", keys)
    return rows.withColumn("path_key", F.md5(F.array_join("path", "")))


def _prefix_keys(path: Column) -> Column:
    """A key for each prefix of the path, chained, so it is found in one pass."""
    chain = lambda done, k: F.concat(
        done, F.array(F.md5(F.concat(F.coalesce(F.element_at(F.concat(F.array(F.lit("")), done), -1), F.lit("")), k)))
    )
    return F.aggregate(path, F.array().cast("array<string>"), chain)


def _in_order(paths: DataFrame) -> DataFrame:
    """Paths with ``shared`` (turns shared with the path before) and ``flat_start``."""
    placed = paths.repartitionByRange("path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id())
    placed = stage(placed, "paths")
    by_part = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per partition
    ends = placed.groupBy("part").agg(F.max("path").alias("last"))
    ends = ends.select("part", F.lag("last").over(by_part).alias("carried"))
    inside = Window.partitionBy("part").orderBy("path")
    rows = placed.join(F.broadcast(ends), "part").withColumn(
        "previous", F.coalesce(F.lag("path").over(inside), "carried", F.array().cast("array<string>"))
    )
    same = bind(F.col("previous"), lambda q: F.transform("path", lambda k, i: k.eqNullSafe(F.get(q, i))))
    first_other = F.array_position(same, False)
    rows = rows.withColumn("shared", F.when(first_other == 0, F.size("path")).otherwise(first_other - 1).cast("int"))
    turn_size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END)
    rows = rows.withColumn("sizes", F.transform("turns", lambda t: turn_size(t).cast("bigint")))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = rows.withColumn("position_start", total(F.slice("sizes", F.lit(1), F.col("shared"))))
    rows = rows.withColumn("length", total(F.col("sizes")) - F.col("position_start")).drop("previous", "carried")
    rows = stage(rows, "tree")
    sums = rows.groupBy("part").agg(F.sum("length").alias("n"))
    starts = sums.select(
        "part", F.coalesce(F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    before = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(starts), "part").withColumn("flat_start", F.col("base") + before)


def _block_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")


def _loss(turns: Column, sizes: Column) -> Column:
    """Intervals of the learned texts inside the block's text."""
    zero = F.lit(0).cast("bigint")
    starts = bind(
        sizes,
        lambda s: F.transform(
            s, lambda x, i: F.aggregate(F.slice(s, F.lit(1), i), zero, lambda a, y: a + y)
        ),
    )
    spans = bind(
        starts,
        lambda at: F.transform(
            turns,
            lambda t, i: F.struct(
                t["learned"].alias("learned"),
                (F.get(at, i) + F.length(t["head"])).alias("start"),
                (F.get(at, i) + F.length(t["head"]) + F.length(t["body"])).alias("end"),
            ),
        ),
    )
    return F.transform(
        F.filter(spans, lambda x: x["learned"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    )


def build_tree(conversations: DataFrame) -> Tree:
    """Blocks with ``text``, ``flat_start``, ``position_start``, ``loss``, ``pieces`` and ``attention``.

    ``pieces`` names the ancestors' parts block by block (block, from, to); ``attention`` has the same as
    intervals of the flat sequence, touching ones joined.
    """
    convs = stage(_paths(conversations), "conversations")
    distinct = convs.groupBy("path_key").agg(F.first(F.struct("path", "turns")).alias("p"))
    rows = stage(_in_order(distinct.select("path_key", "p.path", "p.turns")), "ordered")
    own_turns = F.slice("turns", F.col("shared") + 1, F.size("turns"))
    own_sizes = F.slice("sizes", F.col("shared") + 1, F.size("turns"))
    blocks = rows.select(
        F.col("path_key").alias("block"),
        "flat_start",
        "position_start",
        "length",
        _block_text(own_turns).alias("text"),
        _loss(own_turns, own_sizes).alias("loss"),
    )
    keyed = rows.select("path_key", "shared", "sizes", "flat_start", _prefix_keys(F.col("path")).alias("prefixes"))
    turns = keyed.select("path_key", "shared", "flat_start", F.posexplode(F.arrays_zip("prefixes", "sizes")))
    turns = turns.select("path_key", "shared", "flat_start", "pos", F.col("col.prefixes").alias("prefix"), F.col("col.sizes").alias("size"))
    own = turns.where(F.col("pos") >= F.col("shared"))
    before = Window.partitionBy("path_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    nodes = own.select(
        "prefix",
        F.col("path_key").alias("block"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("from"),
        F.col("size").alias("n"),
        F.col("flat_start").alias("block_start"),
    )
    wanted = turns.where(F.col("pos") < F.col("shared")).select("path_key", "pos", "prefix")
    found = wanted.join(nodes, "prefix")
    pieces = found.groupBy("path_key", "block", "block_start").agg(
        F.min("pos").alias("pos"), F.min("from").alias("from"), F.max(F.col("from") + F.col("n")).alias("to")
    )
    piece = F.struct("pos", "block", "block_start", "from", "to")
    pieces = pieces.groupBy("path_key").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    empty = F.array().cast("array<struct<pos:int,block:string,block_start:bigint,from:bigint,to:bigint>>")
    blocks = blocks.join(pieces.withColumnRenamed("path_key", "block"), "block", "left")
    blocks = blocks.withColumn("pieces", F.coalesce("pieces", empty))
    blocks = blocks.withColumn("attention", _joined(F.col("pieces")))
    return Tree(stage(blocks, "blocks"), convs.select("conv_id", F.col("path_key").alias("block")))


def _joined(pieces: Column) -> Column:
    """Flat intervals of the pieces; one that starts where the last ends is added to it."""
    kind = "array<struct<start:bigint,end:bigint>>"
    flat = F.transform(
        pieces,
        lambda p: F.struct((p["block_start"] + p["from"]).alias("start"), (p["block_start"] + p["to"]).alias("end")),
    )
    add = lambda done, x: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] == x["start"]),
        F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(F.get(done, F.size(done) - 1)["start"].alias("start"), x["end"].alias("end"))),
        ),
    ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(flat, F.array().cast(kind), add)


def read_back(tree: Tree) -> DataFrame:
    """Conversations rebuilt from the blocks: ``conv_id``, ``turns`` (role, text), ``formatted``, ``learned``."""
    blocks = tree.blocks
    own = blocks.select("block", F.lit(1 << 30).alias("pos"), "text", "loss")
    parts = blocks.select(F.col("block").alias("owner"), F.explode("pieces").alias("p")).select(
        "owner", "p.pos", "p.block", "p.from", "p.to"
    )
    inside = F.filter("loss", lambda x: (x["start"] >= F.col("from")) & (x["end"] <= F.col("to")))
    moved = F.transform(
        inside, lambda x: F.struct((x["start"] - F.col("from")).alias("start"), (x["end"] - F.col("from")).alias("end"))
    )
    text = F.expr("substring(text, cast(from + 1 as int), cast(to - from as int))")
    parts = parts.join(blocks.select("block", "text", "loss"), "block").select(
        F.col("owner").alias("block"), "pos", text.alias("text"), moved.alias("loss")
    )
    learned = F.transform("loss", lambda x: F.substring(F.col("text"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))
    every = parts.unionByName(own).select("block", F.struct("pos", "text", learned.alias("learned")).alias("p"))
    whole = every.groupBy("block").agg(F.array_sort(F.collect_list("p")).alias("p"))
    whole = whole.select(
        "block",
        F.array_join(F.transform("p", lambda x: x["text"]), "").alias("formatted"),
        F.array_join(F.transform(F.flatten(F.transform("p", lambda x: x["learned"])), unescape), "").alias("learned"),
    )
    chunks = F.filter(F.split("formatted", r"<\|end\|>"), lambda x: x != "")
    fields = F.transform(chunks, lambda x: F.split(F.substring(x, len(TURN) + 1, 1 << 30), r"<\|text\|>", 2))
    turns = F.transform(
        fields, lambda x: F.struct(unescape(F.get(x, F.lit(0))).alias("role"), unescape(F.get(x, F.lit(1))).alias("text"))
    )
    whole = whole.withColumn("turns", turns)
    return tree.members.join(whole, "block").drop("block")


def chat_sql(extra: str) -> str:
    """DuckDB SQL for what :func:`read_back` gives of ``conversations`` and the rows listed in ``extra``."""
    marks = len(TURN) + len(TEXT) + len(END)
    controls = ["\\", "<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
    # Escaping adds one character for each control string and backslash.
    added = lambda c: " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in controls)
    size = lambda c: f"length({c}) + {added(c)}"
    place = "ORDER BY turn, role, text"
    return f"""
    WITH said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES {extra})
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' {place})) AS turns_sha256,
      CAST(sum(CASE WHEN role = '{LEARNED_ROLE}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(string_agg(CASE WHEN role = '{LEARNED_ROLE}' THEN text ELSE '' END, '' {place})) AS loss_sha256,
      CAST(sum({marks} + {size('role')} + {size('text')}) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id
    """
