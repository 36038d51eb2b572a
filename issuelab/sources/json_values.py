"""Files that hold one JSON value of any size: told apart from JSON lines, and taken apart into elements, in parallel.

A file is scanned in the splits that Spark makes of it, as rows that end at ``},``; splits and rows both end
there, and a string or a nested value may go on across them. Two passes find the elements:

1. Each split is summed up as a function of what it starts in: for a start outside and inside a string, whether it
   ends inside one, how much deeper it ends, and how shallow its closing brackets get. One row per split is
   stitched per file, which gives each split its true start, and tells whether the file is one value: brackets
   close to depth 0 once, at the last character, and every opening bracket stands where a value may begin. In JSON
   lines a second line opens after a closing bracket, so such a file is never taken for one value.
2. Each split, started right, cuts its bytes at the commas of depth 1. An element that goes on across a split leaves
   a piece in either; pieces (two per split at most) are put together by a shuffle on their element.

So a task holds a batch of rows, and no row holds more than one element; an element must fit a row.

The splits of both passes are the same: same files, same options. One row per split comes to the driver between
them (for 128 MB splits, 100 bytes each).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelab.session import stage

# Functions below run in tasks; they travel there whole, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CUT = "},"
_SPACE = b" \t\r\n"

_SUMMED = (
    "path string, block bigint, size bigint, n_bytes bigint, readable boolean, first string, last string, newline boolean, "
    "out_in boolean, out_depth bigint, out_low bigint, out_lows bigint, out_wrong boolean, "
    "in_in boolean, in_depth bigint, in_low bigint, in_lows bigint, in_wrong boolean"
)
_STITCHED = "path string, block bigint, in_string boolean, depth bigint, kind string, readable boolean"
_PIECE = "path string, block bigint, place bigint, begins boolean, whole boolean, text string"


def fragments(spark: SparkSession, root: str, pattern: str, recursive: bool) -> DataFrame:
    """Rows of all files up to each ``},``, in order within a split."""
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).option("lineSep", _CUT).text(root)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.is_valid_utf8("value").alias("readable"),
        F.col("value").cast("binary").alias("value"),
    )


def _runs(batches: Iterator) -> Iterator[tuple]:
    """(path, block, size, all rows readable, bytes, is first of its split) for the rows of one split in one batch."""
    known = None
    for batch in batches:
        paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
        values, start = batch.column("value").to_pylist(), 0
        while start < len(paths):
            end = start
            while end < len(paths) and paths[end] == paths[start] and blocks[end] == blocks[start]:
                end += 1
            fresh = known != (paths[start], blocks[start])
            known = paths[start], blocks[start]
            data = _CUT.encode().join(values[start:end])
            if not (fresh and blocks[start] == 0):  # all rows but a file's first follow a cut
                data = _CUT.encode() + data
            sizes, readable = batch.column("size"), batch.column("readable").slice(start, end - start)
            yield paths[start], blocks[start], sizes[start].as_py(), all(readable.to_pylist()), data, fresh
            start = end


def _marks(data: bytes):
    """Positions of quotes that open or close strings, of brackets, and +1 or -1 for each bracket."""
    import numpy as np

    a = np.frombuffer(data, dtype=np.uint8)
    quotes = np.flatnonzero(a == 34)
    if b"\\" in data and len(quotes):
        slash = a == 92
        # A run of backslashes ends before position k; an odd one escapes what stands there.
        at = np.arange(len(a))
        last_other = np.maximum.accumulate(np.where(slash, -1, at))
        before = quotes - 1
        run = np.where(before >= 0, before - last_other[np.maximum(before, 0)], 0)
        quotes = quotes[run % 2 == 0]
    low = a | 32  # [ and {, ] and } differ in one bit
    brackets = np.flatnonzero((low == 123) | (low == 125))
    return a, quotes, brackets, np.where(low[brackets] == 123, 1, -1)


def _summary(a, quotes, brackets, steps, inside: bool, at_start: bool) -> tuple:
    """(ends inside a string, depth gained, least depth after a closing bracket, how often, a value opens out of place)."""
    import numpy as np

    outside = (np.searchsorted(quotes, brackets) + inside) % 2 == 0
    where, step = brackets[outside], steps[outside]
    depth = step.cumsum()
    closing = depth[step < 0]
    low = int(closing.min()) if len(closing) else None
    opens = where[step > 0]
    solid = ~np.isin(a, np.frombuffer(_SPACE, dtype=np.uint8))
    last = np.maximum.accumulate(np.where(solid, np.arange(len(a)), -1)) if len(a) else a
    before = last[opens - 1] if len(opens) else opens
    before = np.where(opens == 0, -1, before)
    allowed = np.isin(a[np.maximum(before, 0)], np.frombuffer(b"[:,", dtype=np.uint8)) | ((before < 0) & at_start)
    return (
        bool((len(quotes) + inside) % 2), int(depth[-1]) if len(depth) else 0, low,
        int((closing == low).sum()) if low is not None else 0, bool((~allowed).any()),
    )


def _joined(one: tuple, two: tuple) -> tuple:
    """Summary of two stretches, the second from where the first ends."""
    inside, depth, low, lows, wrong = two
    low = None if low is None else low + one[1]
    least = min((x for x in (one[2], low) if x is not None), default=None)
    count = sum(n for x, n in ((one[2], one[3]), (low, lows)) if x is not None and x == least)
    return inside, one[1] + depth, least, count, one[4] or wrong


def _sum_up(batches: Iterator) -> Iterator:
    import pyarrow as pa

    done, now = [], None
    for path, block, size, readable, data, fresh in _runs(batches):
        if fresh:
            now = {"path": path, "block": block, "size": size, "n_bytes": 0, "readable": True, "first": None, "last": None, "newline": False}
            now["states"] = {False: (False, 0, None, 0, False), True: (True, 0, None, 0, False)}
            done.append(now)
        marks = _marks(data)
        parts = {s: _summary(*marks, s, block == 0 and fresh) for s in (False, True)}
        now["states"] = {s: _joined(state, parts[state[0]]) for s, state in now["states"].items()}
        bare = data.strip(_SPACE)
        now["n_bytes"] += len(data)
        now["readable"] &= readable
        now["newline"] |= b"\n" in bare
        if bare:
            now["first"] = now["first"] or chr(bare[0])
            now["last"] = chr(bare[-1])
    rows = [
        [r[c] for c in ("path", "block", "size", "n_bytes", "readable", "first", "last", "newline")]
        + [v for s in (False, True) for v in r["states"][s]]
        for r in done
    ]
    if rows:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.bool_()]
        kinds += [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()] * 2
        names = [c.split()[0] for c in _SUMMED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _stitch(splits):
    """True start of each split of a file; ``kind`` is array or object if the file may be one value."""
    import pandas as pd

    rows = splits.sort_values("block").to_dict("records")
    number = lambda v: None if v is None or v != v else int(v)
    state, starts = (False, 0, None, 0, False), []
    for r in rows:
        starts.append((r["path"], r["block"], state[0], state[1]))
        side = "in" if state[0] else "out"
        own = bool(r[f"{side}_in"]), int(r[f"{side}_depth"]), number(r[f"{side}_low"]), int(r[f"{side}_lows"]), bool(r[f"{side}_wrong"])
        state = _joined(state, own)
    first = next((r["first"] for r in rows if r["first"]), "")
    last = next((r["last"] for r in reversed(rows) if r["last"]), "")
    whole = sum(r["n_bytes"] for r in rows) in (rows[0]["size"], rows[0]["size"] - 3)  # less a byte order mark
    one = state == (False, 0, 0, 1, False) and whole
    kind = "array" if one and first + last == "[]" else None
    # An object on one line is a line.
    if one and first + last == "{}" and any(r["newline"] for r in rows):
        kind = "object"
    readable = all(r["readable"] for r in rows)
    return pd.DataFrame([(*s, kind, readable) for s in starts], columns=[c.split()[0] for c in _STITCHED.split(", ")])


def survey(rows: DataFrame) -> DataFrame:
    """``path``, ``block``, ``in_string``, ``depth`` (of the split's start), ``kind`` and ``readable`` (of the file)."""
    summed = rows.mapInArrow(_sum_up, _SUMMED)
    # The number is given: adaptive execution takes these few bytes for one task, however many files there are.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return summed.repartition(tasks, "path").groupBy("path").applyInPandas(_stitch, _STITCHED)


def _cut_up(starts: dict):
    """Splits to elements and pieces of elements. ``starts``: (path, block) to (inside a string, depth, kind)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rows, held = [], 0
        state = {}

        def given():
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            names = [c.split()[0] for c in _PIECE.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        def close():
            """What is left of a split: it goes on in the next one."""
            if state and state["left"] is not None:
                rows.append((state["path"], state["block"], state["place"], state["begun"], False, b"".join(state["left"]).decode()))

        for path, block, _, _, data, fresh in _runs(batches):
            if fresh:
                close()
                inside, depth, kind = starts[path, block]
                state = {"path": path, "block": block, "place": 0, "begun": block == 0, "left": [], "in": inside, "depth": depth, "kind": kind}
                state["skip"] = block == 0 and kind == "array"
            if state["kind"] == "object":
                state["left"].append(data)
                continue
            if state["left"] is None:
                continue  # only white space follows the end of the array
            a, quotes, brackets, steps = _marks(data)
            outside = (np.searchsorted(quotes, brackets) + state["in"]) % 2 == 0
            where, step = brackets[outside], steps[outside]
            level = np.concatenate([[0], step.cumsum()]) + state["depth"]
            commas = np.flatnonzero(a == 44)
            commas = commas[(np.searchsorted(quotes, commas) + state["in"]) % 2 == 0]
            commas = commas[level[np.searchsorted(where, commas)] == 1]
            final = where[(level[1:] == 0) & (step < 0)]
            at = 0
            if state["skip"]:
                at, state["skip"] = int(where[0]) + 1, False
            for end in [*commas.tolist(), *final.tolist()[:1]]:
                text = b"".join([*state["left"], data[at:end]]).decode()
                rows.append((path, block, state["place"], state["begun"], state["begun"], text))
                held += len(text)
                state["left"], state["begun"], state["place"], at = [], True, state["place"] + 1, end + 1
                if held >= 4 << 20:
                    yield given()
                    rows, held = [], 0
            if len(final):
                state["left"] = None
            else:
                state["left"].append(data[at:])
            state["in"] = bool((len(quotes) + state["in"]) % 2)
            state["depth"] = int(level[-1])
        close()
        if rows:
            yield given()

    return run


def elements(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``path`` and ``text`` of every element of the arrays, and of the objects, that ``found`` (a survey) names.

    The texts are not checked yet: a file is one JSON value only if all of them are (an empty array has one blank text).
    """
    spark = rows.sparkSession
    wanted = found.where("kind is not null and readable").collect()
    if not wanted:
        return spark.createDataFrame([], "path string, text string")
    starts = {(r["path"], r["block"]): (r["in_string"], r["depth"], r["kind"]) for r in wanted}
    paths = found.where("kind is not null and readable").select("path").distinct()
    own = rows.join(F.broadcast(paths), "path", "left_semi").select(*rows.columns)
    cut = stage(own.mapInArrow(_cut_up(starts), _PIECE), "pieces")
    order = Window.partitionBy("path").orderBy("block", "place")
    broken = cut.where("not whole").withColumn("element", F.sum(F.col("begins").cast("int")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("block", "place", "text")))
    joined = broken.groupBy("path", "element").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"))
    return cut.where("whole").select("path", "text").unionByName(joined.select("path", "text"))
