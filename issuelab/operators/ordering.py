"""Order statistics without a single-task sort.

A window over a whole table, or over one group that holds a third of it, runs in one task. Here the
rows are range-partitioned on (group, order), so a hot group is split over many tasks; the totals of
earlier partitions are then added to each partition's local running sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelab.session import stage

_PART = "_part"


def _place(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Range-partition on ``keys``, sort inside partitions, note the partition, write once."""
    ordered = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return stage(ordered.withColumn(_PART, F.spark_partition_id()), label)


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Sequence[str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_all`` for each column in ``totals``.

    ``<c>_before`` sums the rows of the same group that come earlier in ``order`` (ascending) and
    ``<c>_all`` sums the whole group. (group, order) must identify a row; aggregate to it first.
    """
    group = list(group)
    placed = _place(df, [*group, *order], "ordered")
    per_part = placed.groupBy(_PART, *group).agg(*[F.sum(c).alias(f"_p_{c}") for c in totals])
    # One row per partition a group touches, so these windows stay small even for a hot group.
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        _PART,
        *group,
        *[F.coalesce(F.sum(f"_p_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in totals],
        *[F.sum(f"_p_{c}").over(whole).alias(f"{c}_all") for c in totals],
    )
    if group:
        named = offsets.select(
            F.col(_PART).alias("_r_part"),
            *[F.col(g).alias(f"_r_{g}") for g in group],
            *[c for c in offsets.columns if c != _PART and c not in group],
        )
        match = F.col(_PART) == F.col("_r_part")
        for g in group:
            match &= F.col(g).eqNullSafe(F.col(f"_r_{g}"))
        joined = placed.join(named, match)
    else:
        joined = placed.join(F.broadcast(offsets), _PART)  # at most one row per partition
    local = (
        Window.partitionBy(_PART, *group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(local), F.lit(0))).alias(f"{c}_before")
            for c in totals
        ],
        *[f"{c}_all" for c in totals],
    )


def row_positions(df: DataFrame, order: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Add ``pos`` (0-based rank in the group) and ``group_rows``; (group, order) identifies a row."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"], group)
    return ranked.withColumnsRenamed({"_one_before": "pos", "_one_all": "group_rows"}).drop("_one")


def keys_at_positions(
    df: DataFrame, order: Sequence[str], positions_of: Callable[[int], Iterable[int]]
) -> tuple[int, dict[int, tuple]]:
    """Row count and the key tuples found at chosen global positions.

    ``positions_of(n)`` names the wanted positions for n rows. Only the order keys are shuffled and
    only one count per partition plus the few chosen keys reach the driver.
    """
    keys = df.select(*order)
    placed = keys.repartitionByRange(*[F.col(k) for k in order]).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("_slot", F.monotonically_increasing_id()), "cutkeys")
    part = F.shiftright("_slot", 33)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())
    n = sum(size for _, size in sizes)
    slots: dict[int, int] = {}
    for wanted in sorted({p for p in positions_of(n) if 0 <= p < n}):
        start = 0
        for pid, size in sizes:
            if wanted < start + size:
                slots[(pid << 33) + wanted - start] = wanted
                break
            start += size
    if not slots:
        return n, {}
    rows = placed.where(F.col("_slot").isin(list(slots))).collect()
    return n, {slots[r["_slot"]]: tuple(r[k] for k in order) for r in rows}


def before_key(order: Sequence[str], key: Sequence) -> Column:
    """True where the row's order keys come strictly before ``key``; stays pushable to the scan."""
    clauses, equal = [], None
    for name, value in zip(order, key):
        less = F.col(name) < F.lit(value)
        clauses.append(less if equal is None else equal & less)
        same = F.col(name) == F.lit(value)
        equal = same if equal is None else equal & same
    return reduce(lambda a, b: a | b, clauses)


def exact_median(
    df: DataFrame, value: str, group: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact median per group (or of the table), nulls ignored: columns ``group``, ``n``, ``median``.

    A row counts ``weight`` times (once by default). Repeated values collapse to (value, count)
    before the shuffle; a hot group's values are then spread by range rather than gathered in one
    task.
    """
    group = list(group)
    times = F.sum(weight) if weight else F.count("*")
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(times.alias("cnt"))
    ranked = running_totals(counts, [value], ["cnt"], group)
    lower = F.expr("(cnt_all - 1) div 2")
    upper = F.expr("cnt_all div 2")
    covers = lambda p: (F.col("cnt_before") <= p) & (p < F.col("cnt_before") + F.col("cnt"))
    middle = ranked.where(covers(lower) | covers(upper))
    picked = [
        F.max("cnt_all").alias("n"),
        ((F.min(value) + F.max(value)) / F.lit(2.0)).alias("median"),
    ]
    return middle.groupBy(*group).agg(*picked) if group else middle.agg(*picked)


def approx_median(df: DataFrame, value: str, group: Sequence[str] = (), accuracy: int = 10000) -> DataFrame:
    """Sketch-based stand-in for :func:`exact_median` where a bounded rank error is acceptable."""
    aggs = [
        F.count(value).alias("n"),
        F.percentile_approx(value, 0.5, accuracy).cast("double").alias("median"),
    ]
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*group).agg(*aggs) if group else rows.agg(*aggs)


def totals_by(df: DataFrame, sums: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """Collapse rows to one per ``by`` with the given sums, ready for :func:`running_totals`."""
    return df.groupBy(*by).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
