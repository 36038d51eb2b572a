"""Whitening of embeddings through variances of sums: covariance by polarisation, then eigenvectors.

Entries become whole numbers (``floor(scale * c) + offset``), so everything that is counted is counted
exactly. For each dimension and each sum of two dimensions the squares of the centred values are added up:
a value is centred on the whole number ``q`` below its mean, ``u = x - q``, and what the mean is above that,
``r / n`` with ``r = S - n q``, is taken off at the end: ``sum((n x - S)^2) = n^2 sum(u^2) - n r^2``. The
covariance of two dimensions is half of what the variance of their sum has beyond the variances of the two.
These are whole-number sums divided once, so nothing cancels.

Tasks add up whole Arrow batches and give one row per pair of dimensions; what comes to the driver is one
number per pair, ``d (d + 1) / 2`` for d dimensions, whatever the number of rows. ``eigh`` gives the
components there, and the model (d numbers a component) travels inside the tasks that project rows.

Defined results: a vector that is null, has no entries, or holds null or non-finite entries or entries with
``|scale * c| >= 2^53`` takes no part; so does one whose length is not the most frequent (ties: the longer).
The fit list has each distinct whole-number vector once, so copies of a row weigh nothing. Components whose
eigenvalue is zero up to rounding have no scale: ``whitened`` is null there, and they stay out of
``identity_error``, which is null if no component is left. ``deviation`` is a decimal of 38 digits; the query
gives it as a long, null where it exceeds one. Rows of all ids, null and repeated ones too, are kept; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.session import stage

#: Whole numbers up to here are exact in a double.
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Grid:
    """How entries become whole numbers."""

    scale: int = 64
    offset: int = 1_000_000


@dataclass(frozen=True)
class Whitening:
    """Fitted components. ``axes`` has one list of d numbers per component, by falling eigenvalue."""

    n: int
    sums: list[int]
    axes: list[list[float]]
    eigenvalues: list[float]
    trace: float
    kept: int
    identity_error: float | None
    grid: Grid


def on_grid(vectors: DataFrame, grid: Grid = Grid(), column: str = "embedding", name: str = "x") -> DataFrame:
    """``vectors`` that take part, with their whole-number vector in column ``name``."""
    scaled = F.transform(F.col(column), lambda c: c.cast("double") * F.lit(float(grid.scale)))
    usable = F.size(column) > 0
    usable = usable & F.forall(scaled, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(_EXACT)), F.lit(False)))
    whole = F.transform(scaled, lambda c: F.floor(c).cast("bigint") + F.lit(grid.offset).cast("bigint"))
    rows = vectors.withColumn(name, F.when(F.coalesce(usable, F.lit(False)), whole)).where(F.col(name).isNotNull())
    common = rows.groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size(name) == (common["d"] if common else 0))


def _matrix(batch, name: str, d: int):
    import numpy as np

    return np.asarray(batch.column(name).flatten(), dtype=np.int64).reshape(-1, d)


def _dimension_sums(name: str, d: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, n = [0] * d, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, name, d)
                base = x[0].copy()
                part = (x - base).sum(axis=0)
                total = [t + int(p) + int(b) * len(x) for t, p, b in zip(total, part, base)]
                n += len(x)
        if n:
            values = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), values, pa.array([n] * d, pa.int64())], ["i", "total", "n"])

    return run


def _pair_squares(name: str, centre: list[int]):
    """Sums of ``(u_i + u_j)^2`` for i < j, and of ``u_i^2`` as i = j."""
    d = len(centre)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((d, d), dtype=object)
        any_row = False
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                u = (_matrix(batch.slice(start, 1024), name, d) - np.array(centre, dtype=np.int64)).T.copy()
                any_row = True
                if int(np.abs(u).max()) >= 1 << 24:  # (2 u)^2 a thousand times would not fit a long
                    u = u.astype(object)
                part = np.zeros((d, d), dtype=u.dtype)
                for i in range(d):
                    both = u[i:] + u[i]
                    both[0] = u[i]
                    part[i, i:] = (both * both).sum(axis=1)
                total = total + part
        if any_row:
            i, j = np.triu_indices(d)
            values = pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "squares"])

    return run


def _project(u, below, axes, eigenvalues):
    """Whitened rows of centred whole numbers: ``(u - r / n) . axis / sqrt(eigenvalue)``."""
    import numpy as np

    return (u - below) @ (axes / np.sqrt(eigenvalues)[:, None]).T


def _whitened_moments(name: str, centre: list[int], below: list[float], axes, eigenvalues):
    """Sums and sums of products of the whitened components of a task's rows."""
    d, k = len(centre), len(eigenvalues)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = _project(_matrix(batch, name, d) - np.array(centre), np.array(below), axes, eigenvalues)
            first += z.sum(axis=0)
            second += z.T @ z
        i = np.repeat(np.arange(k + 1), k)
        j = np.tile(np.arange(k), k + 1)
        values = np.concatenate([first[None], second]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values)], ["i", "j", "value"])

    return run


def covariance(n: int, sums: list[int], squares: dict[tuple[int, int], int]):
    """Covariance from the sums of squares of ``u`` (see above), each entry rounded once."""
    import numpy as np

    d = len(sums)
    below = [s % n for s in sums]
    # n^2 times a variance; of a sum of two dimensions the part above the whole number is r_i + r_j
    spread = lambda square, r: n * square - r * r
    own = [spread(squares[i, i], below[i]) for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            both = spread(squares[i, j], below[i] + below[j])
            v[i, j] = v[j, i] = float(Fraction(both - own[i] - own[j], 2 * n * n))
    return v


def fit(vectors: DataFrame, components: int = 16, grid: Grid = Grid(), column: str = "embedding") -> Whitening | None:
    """Components of the distinct whole-number vectors; None without vectors."""
    import numpy as np

    rows = on_grid(vectors.select(column), grid, column).select("x").distinct()
    listed = stage(rows, "fit_list")
    one = listed.select(F.size("x").alias("d")).first()
    if one is None:
        return None
    d = one["d"]
    totals = listed.mapInArrow(_dimension_sums("x", d), "i int, total decimal(38,0), n bigint")
    totals = totals.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i").collect()
    n, sums = totals[0]["n"], [int(r["total"]) for r in totals]
    centre = [s // n for s in sums]
    pairs = listed.mapInArrow(_pair_squares("x", centre), "i int, j int, squares decimal(38,0)")
    pairs = pairs.groupBy("i", "j").agg(F.sum("squares").alias("squares")).collect()
    v = covariance(n, sums, {(r["i"], r["j"]): int(r["squares"]) for r in pairs})
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes.T[::-1]
    trace = float(np.trace(v))
    # A zero eigenvalue comes out as rounding of the largest.
    kept = int((values[:components] > max(trace, 0.0) * d * np.finfo(float).eps).sum())
    count = min(components, d)
    error = None
    if kept:
        top, scales = axes[:kept].copy(), values[:kept].copy()
        below = [(s % n) / n for s in sums]
        moments = listed.mapInArrow(_whitened_moments("x", centre, below, top, scales), "i int, j int, value double")
        moments = moments.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
        at = {(r["i"], r["j"]): r["value"] / n for r in moments}
        mean = np.array([at[0, j] for j in range(kept)])
        second = np.array([[at[i + 1, j] for j in range(kept)] for i in range(kept)])
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(kept)).max())
    return Whitening(n, sums, axes[:count].tolist(), [float(e) for e in values[:count]], trace, kept, error, grid)


def _transformed(model: Whitening, kinds: list, key: str, name: str):
    d = len(model.sums)
    centre = [s // model.n for s in model.sums]
    below = [s % model.n for s in model.sums]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        axes, values = np.array(model.axes[: model.kept]), np.array(model.eigenvalues[: model.kept])
        count = len(model.axes)
        explained = [e / model.trace if model.trace > 0 else 0.0 for e in model.eigenvalues]
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                rows = batch.num_rows
                u = _matrix(batch, name, d) - np.array(centre, dtype=np.int64)
                z = np.full((rows, count), np.nan)
                if model.kept:
                    z[:, : model.kept] = _project(u, np.array(below) / model.n, axes, values)
                far = int(np.abs(u).max()) * model.n + model.n  # bounds |n x - S|
                if far * far * d >= 1 << 62:
                    u = u.astype(object)
                off = u * model.n - np.array(below, dtype=u.dtype)
                spread = [Decimal(int(s)) for s in (off * off).sum(axis=1)]
                flat = z.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array(np.repeat(np.arange(rows), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, model.n, dtype=np.int64)),
                        pa.array(spread, kinds[3]).take(pa.array(np.repeat(np.arange(rows), count))),
                        pa.array(flat, mask=np.isnan(flat)),
                        pa.array(np.tile(np.array(explained), rows)),
                        pa.array([model.identity_error] * (rows * count), pa.float64()),
                    ],
                    schema=pa.schema(list(zip(_names(key), kinds))),
                )

    return run


def _names(key: str) -> list[str]:
    return [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]


def transform(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component; see the module for the columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = vectors.schema[key].dataType.simpleString()
    ddl = (
        f"`{key}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    empty = vectors.sparkSession.createDataFrame([], ddl)
    if model is None:
        return empty
    name = "x" if key != "x" else "_x"
    rows = on_grid(vectors.select(key, column), model.grid, column, name).select(key, name)
    rows = rows.where(F.size(name) == len(model.sums))
    kinds = [f.type for f in to_arrow_schema(empty.schema)]
    return rows.mapInArrow(_transformed(model, kinds, key, name), empty.schema)


def as_long(exact: Column) -> Column:
    """A decimal as a long; null where it exceeds one."""
    return exact.try_cast("bigint")
