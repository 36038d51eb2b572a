"""Gradient-boosted trees that go on from their trees: second-order boosting over histograms of binned features.

A fit keeps a written table of the rows (features as one byte each, label, weight, and the margin of all trees
up to the last mark) and the list of its trees. Some thousand rows make a block, one row of that table with a
binary value a column and the features one after the other, so that a pass costs the JVM little. A round adds one tree: each level is one pass that adds up
gradients and Hessians per (leaf, feature, bin) in the tasks, sums them by blocks of features, and brings to the
driver the best split per leaf and block. The first pass of a round also measures the loss on the held-out rows.
So a round costs ``depth`` passes, whatever came before it, and a fit can be carried on (``grow``) for as
long as the loss may still fall. Several fits (folds) share the passes: rows carry the fit they belong to.

Gradients are rounded to whole multiples of ``UNIT`` and added as integers. Sums do not depend on the order or
on the dealing of rows, so a task that is repeated after a lost executor gives the same tree, and so does a fit
that was marked and carried on.

Trees grow leaf by leaf, the largest gain first, up to ``max_leaves`` and ``depth``: levels are grown whole, and
the leaves that would not have been opened are closed again. Leaf values are ``-step * G / (H + l2)`` with the
objective's own Hessian (log loss, or pseudo-Huber of slope 1).

Bounds: the driver holds trees, bin edges and one split per leaf, feature block and fit. A task holds the
histograms of one pass: leaves x features x bins numbers per fit.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from issuelab.session import drop_staged, new_staging_path

# Functions below run in tasks; they travel there whole, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Gradients and losses are whole multiples of 1 / UNIT.
UNIT = 1 << 20
#: Features summed together, and rounds between two marks.
BLOCK = 16
MARK = 10
#: Rows of a written block at most, and bytes of their features; bytes of a row group and of what Python gets at a time.
BLOCK_ROWS, BLOCK_BYTES = 16384, 1 << 21
ROW_GROUP, BATCH_BYTES = 16 << 20, 8 << 20
#: Rows whose values are ranked at a time, bytes of their features, and values kept of them: bin edges are at most
#: 1 / (2 * POINTS) of the rows off in rank, and exact up to POINTS rows.
RANKED_ROWS, RANKED_BYTES, POINTS = 65536, 48 << 20, 5000


@dataclass(frozen=True)
class Boosting:
    """``objective``: ``logistic`` (label 0 or 1) or ``pseudo_huber``. Rows and features are drawn anew for each tree."""

    objective: str = "logistic"
    rounds: int = 8000
    patience: int = 250
    depth: int = 4
    max_leaves: int = 64
    step: float = 0.03
    l2: float = 10.0
    min_child_weight: float = 8.0
    subsample: float = 0.8
    columns: float = 0.8
    bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """Node k is a leaf if ``feature[k]`` is -1; else rows with value <= ``cut[k]`` (bin <= ``bin[k]``) go left."""

    feature: list[int]
    bin: list[int]
    cut: list[float]
    left: list[int]
    right: list[int]
    value: list[float]


@dataclass(frozen=True)
class BoostedTrees:
    objective: str
    base: float
    width: int
    trees: tuple[Tree, ...]

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def numFeatures(self) -> int:
        return self.width

    def first(self, rounds: int) -> BoostedTrees:
        return replace(self, trees=self.trees[:rounds])

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``: a probability for ``logistic``, else the margin."""
        return rows.withColumn("prediction", self._scorer()(_values(rows)))

    def _scorer(self):
        base, trees, objective = self.base, self.trees, self.objective

        @F.arrow_udf("double")
        def score(features):
            import numpy as np
            import pyarrow as pa

            x = np.ascontiguousarray(_matrix(features).T)
            margin = np.full(len(features), base)
            for tree in trees:
                margin += _reached(tree, x, tree.cut, tree.value)
            return pa.array(1 / (1 + np.exp(-margin)) if objective == "logistic" else margin)

        return score


@dataclass(frozen=True)
class Fits:
    """Fits that grow together. ``rows``: path of the marked table; ``marked``: trees in its margins."""

    rows: str
    marked: int
    settings: Boosting
    edges: dict[int, list[list[float]]]
    models: dict[int, BoostedTrees]
    losses: dict[int, list[float]] = field(default_factory=dict)
    turned: frozenset[int] = frozenset()


def _values(rows: DataFrame) -> Column:
    """``features`` as an array of doubles; they may be a vector or such an array."""
    plain = isinstance(rows.schema["features"].dataType, ArrayType)
    return F.col("features") if plain else vector_to_array("features")


# What tasks do.


def _matrix(lists):
    """Rows of numbers of an Arrow column of lists."""
    import numpy as np

    flat = lists.flatten()
    if flat.null_count:
        raise ValueError("null among the features")
    return np.asarray(flat, dtype=float).reshape(len(lists), -1)


def _leaf_values(tree, x, cut):
    """Leaf value of each row of ``x``."""
    return _reached(tree, x.T, cut, tree.value)


def _reached(tree, x, cut, given):
    """What is ``given`` to the leaf that each row reaches. ``x`` holds a row a feature; one comparison a node."""
    import numpy as np

    kind = np.uint8 if len(tree.feature) < 256 else np.uint32

    def below(k):
        f = tree.feature[k]
        if f < 0:
            return kind(k)
        left, right = below(tree.left[k]), below(tree.right[k])
        # Bits of the left leaf where the comparison holds: several times the speed of a choice by ``where``.
        goes = (x[f] <= cut[k]).astype(kind)
        np.negative(goes, out=goes)
        goes &= left ^ right
        goes ^= right
        return goes

    return np.asarray(given).take(np.broadcast_to(below(0), x.shape[1]))


def _blocks(batch):
    """fit, bins (a row a feature), held, keys, label, weight, margin and place in ``batch`` of each block."""
    import numpy as np

    for k, (fit, size) in enumerate(zip(batch.column("fit").to_pylist(), batch.column("size").to_pylist())):
        of = lambda c, kind: np.frombuffer(batch.column(c)[k].as_buffer(), dtype=kind)
        numbers = [of(c, np.float64) for c in ("label", "weight", "margin")]
        yield fit, of("bins", np.uint8).reshape(-1, size), of("held", np.bool_), of("row_key", np.int64), *numbers, k


def _drawn(keys, share, seed, round_no):
    """Rows of a tree: a hash of row, seed and round below ``share``."""
    import numpy as np

    z = keys.astype(np.uint64) ^ np.uint64(((seed * 1_000_003 + round_no) * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z = z ^ (z >> np.uint64(31))
    return z.astype(np.float64) < share * 2.0**64


def _pass(models: dict, marked: int, partial: dict, opened: dict, s: Boosting, columns: list[int], round_no: int, with_loss: bool):
    """Histograms of the opened leaves, by fit and feature block; and losses of the held-out rows.

    ``models``: fit to its trees; ``partial``: fit to the tree being grown; ``opened``: fit to its open leaves.
    """

    def gradients(margin, label, weight):
        import numpy as np

        if s.objective == "logistic":
            p = 1 / (1 + np.exp(-margin))
            g, h = p - label, np.maximum(p * (1 - p), 1e-16)
        else:
            off = margin - label
            root = np.sqrt(1 + off * off)
            g, h = off / root, root**-3
        return np.rint(g * weight * UNIT), np.rint(h * weight * UNIT)

    def loss_of(margin, label, weight):
        import numpy as np

        if s.objective == "logistic":
            return np.logaddexp(0, margin) - label * margin, np.ones(len(margin))
        return np.abs(margin - label) * weight, weight

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums, losses = {}, {}
        for batch in batches:
            for fit, x, held, keys, label, weight, margin, _ in _blocks(batch):
                if fit not in opened:
                    continue
                for tree in models[fit].trees[marked:]:
                    margin = margin + _reached(tree, x, tree.bin, tree.value)
                if with_loss:
                    value, size = loss_of(margin[held], label[held], weight[held])
                    part = np.array([np.rint(value * UNIT).sum(), np.rint(size * UNIT).sum()]).astype(np.int64)
                    losses[fit] = losses.get(fit, 0) + part
                place = np.full(len(partial[fit].feature), -1)
                place[opened[fit]] = np.arange(len(opened[fit]))
                slot = _reached(partial[fit], x, partial[fit].bin, place)
                use = np.flatnonzero(~held & (slot >= 0) & _drawn(keys, s.subsample, s.seed, round_no))
                if not len(use):
                    continue
                both = np.empty(len(use), np.complex128)
                both.real, both.imag = gradients(margin[use], label[use], weight[use])
                first, size = slot[use] * s.bins, len(opened[fit]) * s.bins
                if fit not in sums:
                    sums[fit] = np.zeros((2, len(columns), len(opened[fit]), s.bins), np.int64)
                part = np.zeros((len(columns), size), np.complex128)
                # A feature at a time: its histogram stays in the cache. Gradients and Hessians are added together.
                for at, j in enumerate(columns):
                    np.add.at(part[at], first + x[j].take(use), both)
                for of, v in zip(sums[fit], (part.real, part.imag)):
                    of += v.astype(np.int64).reshape(of.shape)
        rows = [(fit, -1, part.tobytes()) for fit, part in losses.items()]
        for fit, part in sums.items():
            for start in range(0, len(columns), BLOCK):
                rows.append((fit, start, part[:, start : start + BLOCK].swapaxes(1, 2).tobytes()))
        if rows:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, ["fit", "block", "sums"])

    return run


_SPLIT = "fit int, block int, slot int, feature int, bin int, gain double, g long, h long, gl long, hl long"


def _best(opened: dict, s: Boosting, columns: list[int]):
    """Sums of all tasks (sorted by fit and block) to the best split of each leaf in the block."""

    def splits(fit, block, total):
        import numpy as np

        if block < 0:
            return [(fit, block, 0, -1, -1, 0.0, int(total[0]), int(total[1]), 0, 0)]
        width = min(BLOCK, len(columns) - block)
        grid = total.reshape(2, len(opened[fit]), width, s.bins)
        out = []
        for slot in range(len(opened[fit])):
            left = grid[:, slot].cumsum(axis=2)
            whole = left[:, 0, -1]
            gl, hl = left[0] / UNIT, left[1] / UNIT
            gr, hr = whole[0] / UNIT - gl, whole[1] / UNIT - hl
            score = lambda g, h: g * g / (h + s.l2)
            gain = score(gl, hl) + score(gr, hr) - score(whole[0] / UNIT, whole[1] / UNIT)
            gain = np.where((hl >= s.min_child_weight) & (hr >= s.min_child_weight), gain, -np.inf)
            j, b = divmod(int(gain.argmax()), s.bins)
            found = np.isfinite(gain[j, b])
            out.append((
                fit, block, slot, columns[block + j] if found else -1, b, float(gain[j, b]) if found else 0.0,
                int(whole[0]), int(whole[1]), int(left[0, j, b]), int(left[1, j, b]),
            ))
        return out

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, total, out = None, None, []
        for batch in batches:
            for *own, data in zip(*(batch.column(c).to_pylist() for c in ("fit", "block", "sums"))):
                part = np.frombuffer(data, dtype=np.int64)
                if own == key:
                    total = total + part
                    continue
                if key:
                    out += splits(*key, total)
                key, total = own, part
        if key:
            out += splits(*key, total)
        if out:
            kinds = [pa.int32()] * 5 + [pa.float64()] + [pa.int64()] * 4
            names = "fit block slot feature bin gain g h gl hl".split()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def _ranked(batches: Iterator) -> Iterator:
    """Rows (fit, v) to evenly spaced values of each feature, sorted, of ``RANKED_ROWS`` rows of a fit at a time."""
    import numpy as np
    import pyarrow as pa

    def kept(fit, parts):
        values = np.sort(np.concatenate(parts).T, axis=1)
        n = values.shape[1]
        at = np.arange(min(n, POINTS) + 1) * n // min(n, POINTS)
        middle = (at[:-1] + at[1:] - 1) // 2
        columns = [[fit] * len(values), range(len(values)), [n] * len(values), [v[middle].tobytes() for v in values]]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["fit", "feature", "n", "points"])

    waiting = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("v"))
        fits = batch.column("fit").to_numpy(zero_copy_only=False)
        for fit in np.unique(fits).tolist():
            own = waiting.setdefault(fit, [])
            own.append(x[fits == fit])
            if sum(map(len, own)) >= min(RANKED_ROWS, RANKED_BYTES // (8 * max(1, x.shape[1]))):
                yield kept(fit, waiting.pop(fit))
    for fit, own in waiting.items():
        yield kept(fit, own)


def _cuts(shares: list[float]):
    """Kept values (sorted by fit and feature) to the distinct values at the shares of the fit's rows."""

    def cut(fit, feature, parts):
        import numpy as np

        values, weights = [], []
        for n, points in parts:
            values.append(np.frombuffer(points, dtype=float))
            weights.append(np.diff(np.arange(len(values[-1]) + 1) * n // len(values[-1])))
        values, weights = np.concatenate(values), np.concatenate(weights)
        order = np.argsort(values, kind="stable")
        before = weights[order].cumsum()
        rank = np.ceil(np.array(shares) * before[-1])
        return fit, feature, np.unique(values[order][np.searchsorted(before, rank, side="left")]).tolist()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, parts, out = None, [], []
        for batch in batches:
            for *own, n, points in zip(*(batch.column(c).to_pylist() for c in ("fit", "feature", "n", "points"))):
                if own != key and key:
                    out.append(cut(*key, parts))
                    parts = []
                key = own
                parts.append((n, points))
        if key:
            out.append(cut(*key, parts))
        if out:
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["fit", "feature", "cuts"])

    return run


def _blocked(edges: dict):
    """Rows to blocks of rows of one fit; features become one byte, how many edges of the fit lie below the value."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ("held", "row_key", "label", "weight", "margin")
        kinds = (np.bool_, np.int64, np.float64, np.float64, np.float64)
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 6]

        def block(fit, parts):
            *numbers, cells = (np.concatenate(c, axis=-1) for c in zip(*parts))
            values = (fit, cells.shape[1], *(c.tobytes() for c in (*numbers, cells)))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["fit", "size", *names, "bins"])

        waiting = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"))
            fits = batch.column("fit").to_numpy(zero_copy_only=False)
            numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if numbers[0].dtype != np.bool_:
                raise ValueError("held: true or false in every row")
            step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, x.shape[1])))
            for fit in np.unique(fits).tolist():
                own = np.flatnonzero(fits == fit)
                cuts = [np.array(c) for c in edges[fit]]
                parts, size = waiting.pop(fit, ([], 0))
                at = 0
                while at < len(own):
                    of = own[at : at + step - size]
                    at, size = at + len(of), size + len(of)
                    cells = np.empty((x.shape[1], len(of)), np.uint8)
                    for j, c in enumerate(cuts):
                        cells[j] = np.searchsorted(c, x[of, j], side="left")
                    parts.append([*(n[of].astype(kind) for n, kind in zip(numbers, kinds)), cells])
                    if size == step:
                        yield block(fit, parts)
                        parts, size = [], 0
                if size:
                    waiting[fit] = parts, size
        for fit, (parts, _) in waiting.items():
            yield block(fit, parts)

    return run


# What the driver does.


def start(rows: DataFrame, s: Boosting) -> Fits:
    """Bin and write the rows (fit int, held boolean, row_id, label, weight, features); fits without trees.

    The rows are read three times: for the base, for the bin edges and for the blocks.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    values = _values(rows)
    width = rows.select(F.size(values).alias("d")).first()["d"]
    if not 2 <= s.bins <= 256:
        raise ValueError("bins: 2 to 256")
    train = rows.where(~F.col("held"))
    mean = (F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("mean")
    models = {
        row["fit"]: BoostedTrees(s.objective, _base(s.objective, row["mean"]), width, ())
        for row in train.groupBy("fit").agg(mean).collect()
    }
    edges = _edges(train.select(F.col("fit").cast("int").alias("fit"), values.alias("v")), s)
    bases = F.create_map(*[F.lit(v) for f, m in models.items() for v in (f, m.base)])
    ready = rows.where(F.col("fit").isin(list(models))).select(
        F.col("fit").cast("int").alias("fit"),
        "held",
        F.xxhash64("row_id").alias("row_key"),
        F.col("label").cast("double").alias("label"),
        F.col("weight").cast("double").alias("weight"),
        bases[F.col("fit")].alias("margin"),
        values.alias("v"),
    )
    path = _written(ready.mapInArrow(_blocked(edges), _BLOCKS))
    return Fits(path, 0, s, edges, models, {f: [] for f in models})


def _edges(train: DataFrame, s: Boosting) -> dict[int, list[list[float]]]:
    """Bin edges by fit and feature: the distinct values at ``bins`` - 1 equal steps of rank."""
    points = train.mapInArrow(_ranked, "fit int, feature int, n long, points binary")
    dealt = points.repartition("fit", "feature").sortWithinPartitions("fit", "feature")
    cuts = dealt.mapInArrow(_cuts([k / s.bins for k in range(1, s.bins)]), "fit int, feature int, cuts array<double>")
    edges: dict = {}
    for row in sorted(cuts.collect(), key=lambda r: r["feature"]):
        edges.setdefault(row["fit"], []).append(row["cuts"])
    return edges


def _base(objective: str, mean: float) -> float:
    import math

    if objective != "logistic":
        return round(mean, 12)
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    return round(math.log(mean / (1 - mean)), 12)


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Round (from 1) of the lowest loss before ``patience`` rounds without a gain, and whether these occurred."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


_BLOCKS = (
    "fit int, size int, held binary, row_key binary, label binary, weight binary, margin binary, bins binary"
)


def _written(blocks: DataFrame) -> str:
    """Path of the written blocks. Row groups are small, as a reader holds one at a time."""
    path = new_staging_path(blocks.sparkSession, "boost")
    blocks.write.options(**{"compression": "zstd", "parquet.block.size": ROW_GROUP}).parquet(path)
    return path


def _read(spark: SparkSession, fits: Fits) -> DataFrame:
    """The blocks, handed to Python by bytes and not by number."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.schema(_BLOCKS).parquet(fits.rows)


def _one_pass(spark: SparkSession, fits: Fits, partial: dict, opened: dict, columns: list[int], with_loss: bool) -> list:
    s = fits.settings
    round_no = max(len(fits.models[f].trees) for f in opened)
    rows = _read(spark, fits).where(F.col("fit").isin(list(opened)))
    models = {f: fits.models[f] for f in opened}
    sums = rows.mapInArrow(
        _pass(models, fits.marked, partial, opened, s, columns, round_no, with_loss), "fit int, block int, sums binary"
    )
    dealt = sums.repartition("fit", "block").sortWithinPartitions("fit", "block")
    return dealt.mapInArrow(_best(opened, s, columns), _SPLIT).collect()


def _add_tree(spark: SparkSession, fits: Fits, active: list[int]) -> Fits:
    """One round for the active fits: their loss so far is measured, then a tree is grown."""
    import numpy as np

    s = fits.settings
    round_no = len(fits.models[active[0]].trees)
    width = fits.models[active[0]].width
    draw = np.random.default_rng([s.seed, round_no])
    columns = sorted(draw.choice(width, max(1, round(width * s.columns)), replace=False).tolist())
    nodes = {f: _Growing() for f in active}
    opened = {f: [0] for f in active}
    losses = dict(fits.losses)
    for level in range(s.depth):
        found = _one_pass(spark, fits, {f: nodes[f].tree() for f in opened}, opened, columns, level == 0)
        if level == 0:
            for r in found:
                if r["block"] < 0 and r["h"]:
                    losses[r["fit"]] = [*losses[r["fit"]], r["g"] / r["h"]]
        best: dict = {}
        for r in sorted((r for r in found if r["block"] >= 0), key=lambda r: (-r["gain"], r["feature"])):
            best.setdefault((r["fit"], r["slot"]), r)
        after: dict = {}
        for (fit, slot), r in sorted(best.items()):
            leaf = opened[fit][slot]
            if level == 0:
                nodes[fit].sums[leaf] = (r["g"], r["h"])
            if r["feature"] >= 0 and r["gain"] > 1e-6:
                cut = fits.edges[fit][r["feature"]]
                cut = cut[r["bin"]] if r["bin"] < len(cut) else float("inf")
                after.setdefault(fit, []).extend(nodes[fit].split(leaf, r, cut))
        opened = after
        if not opened:
            break
    models = dict(fits.models)
    for f in active:
        models[f] = replace(models[f], trees=(*models[f].trees, nodes[f].closed(s)))
    return replace(fits, models=models, losses=losses)


class _Growing:
    """A tree on its way; sums are gradients and Hessians in units."""

    def __init__(self):
        self.feature, self.bin, self.cut, self.left, self.right, self.gain = [-1], [0], [0.0], [0], [0], [0.0]
        self.sums = [(0, 0)]

    def split(self, leaf: int, r, cut: float) -> tuple[int, int]:
        left = len(self.feature)
        for sums in ((r["gl"], r["hl"]), (r["g"] - r["gl"], r["h"] - r["hl"])):
            for column, value in ((self.feature, -1), (self.bin, 0), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.gain, 0.0)):
                column.append(value)
            self.sums.append(sums)
        self.feature[leaf], self.bin[leaf], self.cut[leaf], self.gain[leaf] = r["feature"], r["bin"], cut, r["gain"]
        self.left[leaf], self.right[leaf] = left, left + 1
        return left, left + 1

    def tree(self) -> Tree:
        return Tree(list(self.feature), list(self.bin), list(self.cut), list(self.left), list(self.right), [0.0] * len(self.feature))

    def closed(self, s: Boosting) -> Tree:
        """The leaves that are opened when the largest gain always goes first, and their values."""
        split, edge = set(), [0]
        while len(split) + 1 < s.max_leaves:
            edge = sorted((k for k in edge if self.feature[k] >= 0), key=lambda k: (-self.gain[k], k))
            if not edge:
                break
            k = edge.pop(0)
            split.add(k)
            edge += [self.left[k], self.right[k]]
        value = [-s.step * (g / UNIT) / (h / UNIT + s.l2) for g, h in self.sums]
        return replace(self.tree(), feature=[f if k in split else -1 for k, f in enumerate(self.feature)], value=value)


def grow(spark: SparkSession, fits: Fits, rounds: int | None = None) -> Fits:
    """Add trees to every fit whose held-out loss has not turned: ``rounds`` more at most, ``settings.rounds`` in all.

    Without held-out rows a fit has no losses and grows ``2 * patience`` trees.
    """
    s = fits.settings
    goal = s.rounds if rounds is None else min(s.rounds, max(len(m.trees) for m in fits.models.values()) + rounds)
    while True:
        turned = {f for f, losses in fits.losses.items() if losses and best_round(losses[1:], s.patience)[1]}
        # The loss of the first k trees is measured when tree k + 1 is grown.
        blind = {
            f for f, m in fits.models.items() if len(m.trees) >= 2 * s.patience and not fits.losses[f]
        }
        fits = replace(fits, turned=fits.turned | turned | blind)
        active = [f for f in fits.models if f not in fits.turned and len(fits.models[f].trees) < goal]
        if not active:
            return fits
        if len(fits.models[active[0]].trees) - fits.marked >= MARK:
            fits = mark(spark, fits)
        fits = _add_tree(spark, fits, active)


def mark(spark: SparkSession, fits: Fits) -> Fits:
    """Write the margins of all trees so far; passes start from there."""
    models, marked = fits.models, fits.marked

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            margins = []
            for fit, x, *_, margin, _ in _blocks(batch):
                for tree in models[fit].trees[marked:]:
                    margin = margin + _reached(tree, x, tree.bin, tree.value)
                margins.append(margin.tobytes())
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(margins, pa.binary()))

    rows = _read(spark, fits).where(~F.col("fit").isin(list(fits.turned)))
    path = _written(rows.mapInArrow(run, _BLOCKS))
    drop_staged(spark, fits.rows)
    return replace(fits, rows=path, marked=max(len(m.trees) for m in models.values()))


def last_loss(spark: SparkSession, fits: Fits) -> Fits:
    """Measure the losses that the last trees leave, where a fit ended by its rounds and not by patience."""
    waiting = [f for f in fits.models if f not in fits.turned and 0 < len(fits.losses[f]) <= len(fits.models[f].trees)]
    if not waiting:
        return fits
    losses = dict(fits.losses)
    nothing = {f: _Growing().tree() for f in waiting}
    for r in _one_pass(spark, fits, nothing, {f: [0] for f in waiting}, [0], True):
        if r["block"] < 0 and r["h"]:
            losses[r["fit"]] = [*losses[r["fit"]], r["g"] / r["h"]]
    return replace(fits, losses=losses)


def fit_many(rows: DataFrame, s: Boosting) -> dict[int, tuple[BoostedTrees, list[float]]]:
    """Each fit's model, cut back to the round of its lowest held-out loss, and its losses by round.

    ``rows``: fit int, held boolean, row_id, label, weight, features (a vector, or an array of doubles). The model of a fit without held-out rows
    keeps all its trees.
    """
    spark = rows.sparkSession
    fits = last_loss(spark, grow(spark, start(rows, s)))
    drop_staged(spark, fits.rows)
    out = {}
    for f, model in fits.models.items():
        curve = fits.losses[f][1:]
        out[f] = (model.first(best_round(curve, s.patience)[0]) if curve else model, curve)
    return out


_PARTS = ("feature", "bin", "cut", "left", "right", "value")
_SAVED = (
    "place int, feature array<int>, bin array<int>, cut array<double>, `left` array<int>, `right` array<int>, "
    "value array<double>"
)


def save(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    rows = [(k, t.feature, t.bin, t.cut, t.left, t.right, t.value) for k, t in enumerate(model.trees)]
    spark.createDataFrame(rows, _SAVED).write.mode("overwrite").parquet(f"{path}/trees")
    about = {k: v for k, v in asdict(replace(model, trees=())).items() if k != "trees"}
    spark.createDataFrame([about]).write.mode("overwrite").json(f"{path}/about")


def load(spark: SparkSession, path: str) -> BoostedTrees:
    about = spark.read.schema("objective string, base double, width int").json(f"{path}/about").first()
    rows = spark.read.schema(_SAVED).parquet(f"{path}/trees").orderBy("place").collect()
    trees = tuple(Tree(*(list(r[c]) for c in _PARTS)) for r in rows)
    return BoostedTrees(about["objective"], about["base"], about["width"], trees)
