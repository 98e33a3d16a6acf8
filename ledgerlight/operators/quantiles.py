"""Exact, linearly interpolated quantiles that hold at any table size.

Spark's exact ``percentile`` keeps every distinct value of a column in one buffer. That is the
quickest way for a small column, and no way at all for a large one. Beyond ``small_rows`` values the
wanted order statistics are narrowed down instead: sketch quantiles propose cut points, one counting
pass says exactly which interval each wanted rank falls into, and the loop goes on inside those
intervals that still hold many rows. All columns share each pass, which is a scan with map-side
counting; values are shuffled only in the last one, which ranks each interval's by itself: a small
share of the table, spread over as many tasks as there are intervals. The driver holds the cut points,
whose number is bounded whatever the number of intervals. A value that fills a large share of the
table gets an interval of its own and is settled by the first count.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SMALL_ROWS = 1_000_000
# ``percentile`` walks all its values once per probability
SMALL_WORK = 30_000_000
SKETCH_ACCURACY = 10_000
CUTS_PER_INTERVAL = 200
# of all intervals together: the driver holds them
MOST_CUTS = 50_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    small_rows: int = SMALL_ROWS,
    present: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of every column, nulls ignored; None where a column holds no value.

    ``present`` holds the number of values per column if they have been counted already.
    """
    if not isinstance(columns, Mapping):
        columns = {name: F.col(f"`{name}`") for name in columns}
    names = list(columns)
    wanted = [float(p) for p in probabilities]
    result: dict[str, list[float | None]] = {n: [None] * len(wanted) for n in names}
    if not names:
        return result
    numbers = df.select(*[number_or_missing(columns[n]).alias(f"v{i}") for i, n in enumerate(names)])
    if present is None:
        counts = list(numbers.agg(*[F.count(f"v{i}") for i in range(len(names))]).first())
    else:
        counts = [present[n] for n in names]

    small_rows = min(small_rows, SMALL_WORK // max(len(wanted), 1))
    small = [i for i, rows in enumerate(counts) if 0 < rows <= small_rows]
    if small:
        grid = F.array(*map(F.lit, wanted))
        row = numbers.agg(*[F.percentile(f"v{i}", grid) for i in small]).first()
        for i, values in zip(small, row):
            result[names[i]] = list(values)
    large = {i: rows for i, rows in enumerate(counts) if rows > small_rows}
    if large:
        found = _select(numbers, large, wanted, small_rows)
        for i, rows in large.items():
            places = [p * (rows - 1) for p in wanted]
            result[names[i]] = [_between(found[i, math.floor(x)], found[i, math.ceil(x)], x) for x in places]
    return result


def number_or_missing(column: Column) -> Column:
    """The value as a double, NaN counting as missing."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def grid_points(count: int, low: float, high: float) -> list[float]:
    """Evenly spaced probabilities, both ends included."""
    step = (high - low) / (count - 1)
    return [low + i * step for i in range(count - 1)] + [high]


def interval_index(df: DataFrame, column: str, edges: Sequence[float], name: str) -> DataFrame:
    """Add the index of the left-closed interval a value lies in; values past the ends are not allowed."""
    indexed = Bucketizer(splits=list(edges), inputCol=column, outputCol=name).transform(df)
    return indexed.withColumn(name, F.col(name).cast("int"))


@dataclass
class _Interval:
    """Values of one column in [low, high), of which ``below`` others of the column are smaller."""

    column: int
    low: float
    high: float
    below: int
    rows: int
    ranks: list[int] = field(default_factory=list)


Found = dict[tuple[int, int], float]  # (column, rank) to value


def _select(numbers: DataFrame, counts: dict[int, int], wanted: list[float], small_rows: int) -> Found:
    pending = []
    cuts = {}
    sketches = []
    proposals: dict[tuple[float, ...], Column] = {}
    for n, (i, rows) in enumerate(counts.items()):
        ranks = sorted({r for p in wanted for r in (math.floor(p * (rows - 1)), math.ceil(p * (rows - 1)))})
        pending.append(_Interval(i, -math.inf, math.inf, 0, rows, ranks))
        margin = 2 / SKETCH_ACCURACY
        near = [min(1.0, max(0.0, r / (rows - 1) + d)) for r in ranks for d in (-margin, margin)]
        # one literal, shared by columns of as many values
        if tuple(near) not in proposals:
            proposals[tuple(near)] = F.lit(np.array(near))
        sketches.append(F.percentile_approx(f"v{i}", proposals[tuple(near)], SKETCH_ACCURACY))
        cuts[n] = None
    for n, proposed in enumerate(numbers.agg(*sketches).first()):
        cuts[n] = proposed

    found: Found = {}
    narrow: list[_Interval] = []
    while pending:
        kept = _narrow(numbers, pending, cuts, found)
        narrow += [i for i in kept if i.rows <= small_rows]
        pending = [i for i in kept if i.rows > small_rows]
        if pending:
            cuts = _propose(numbers, pending)
    if narrow:
        found.update(_finish(numbers, narrow))
    return found


def _between(low: float, high: float, position: float) -> float:
    share = position - math.floor(position)
    return low if share == 0 or low == high else low + (high - low) * share


def _edges(intervals: Sequence[_Interval], column: int) -> set[float]:
    own = [i for i in intervals if i.column == column]
    return {-math.inf, math.inf} | {e for i in own for e in (i.low, i.high)}


def _slots(numbers: DataFrame, edges: Mapping[int, Sequence[float]]) -> DataFrame:
    """One row per value: (column, slot, value), the slot counted along the column's edges."""
    ids = list(edges)
    indexed = Bucketizer(
        splitsArray=[list(edges[i]) for i in ids],
        inputCols=[f"v{i}" for i in ids],
        outputCols=[f"s{i}" for i in ids],
    ).transform(numbers.select(*[f"v{i}" for i in ids]))
    cells = F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(f"s{i}").cast("int").alias("slot"), F.col(f"v{i}").alias("value"))
        for i in ids
    ])
    return indexed.select(F.inline(cells)).where(F.col("slot").isNotNull())


def _inside(numbers: DataFrame, intervals: Sequence[_Interval]) -> DataFrame:
    """Values of the given intervals only, with the interval's place in the list.

    The places are a small table: as literals of the plan, many columns with many quantiles fill the driver.
    """
    edges = {i: sorted(_edges(intervals, i)) for i in sorted({i.column for i in intervals})}
    slots = {column: {low: slot for slot, low in enumerate(own)} for column, own in edges.items()}
    listed = [(i.column, slots[i.column][i.low], n) for n, i in enumerate(intervals)]
    places = numbers.sparkSession.createDataFrame(listed, "column int, slot int, interval int")
    return _slots(numbers, edges).join(F.broadcast(places), ["column", "slot"]).select("interval", "value")


def _propose(numbers: DataFrame, intervals: Sequence[_Interval]) -> dict[int, list[float]]:
    pieces = max(2, min(CUTS_PER_INTERVAL, MOST_CUTS // len(intervals)))
    steps = F.array(*[F.lit(i / pieces) for i in range(pieces + 1)])
    sketched = _inside(numbers, intervals).groupBy("interval")
    rows = sketched.agg(F.percentile_approx("value", steps, SKETCH_ACCURACY).alias("cuts")).collect()
    return {row["interval"]: row["cuts"] for row in rows}


def _narrow(
    numbers: DataFrame, intervals: Sequence[_Interval], cuts: Mapping[int, Sequence[float]], found: Found
) -> list[_Interval]:
    """Count the pieces the cuts make and keep those that still hide a wanted rank."""
    edges: dict[int, list[float]] = {}
    for column in sorted({i.column for i in intervals}):
        proposed = {c for n, i in enumerate(intervals) if i.column == column for c in cuts[n]}
        # each cut value stands alone in [cut, next double), however often it occurs
        after = {math.nextafter(c, math.inf) for c in proposed}
        edges[column] = sorted(_edges(intervals, column) | proposed | after)
    rows = _slots(numbers, edges).groupBy("column", "slot").count().collect()
    counted = {(row["column"], row["slot"]): row["count"] for row in rows}

    kept: list[_Interval] = []
    for column, own in edges.items():
        wanted = sorted({r for i in intervals if i.column == column for r in i.ranks})
        below = 0
        for slot, (low, high) in enumerate(zip(own, own[1:])):
            size = counted.get((column, slot), 0)
            here = wanted[bisect_left(wanted, below):bisect_left(wanted, below + size)]
            if here and high == math.nextafter(low, math.inf):
                found.update({(column, r): low for r in here})
            elif here:
                kept.append(_Interval(column, low, high, below, size, here))
            below += size
    return kept


def _finish(numbers: DataFrame, intervals: Sequence[_Interval]) -> Found:
    """Rank the values left, grouped to distinct ones first, inside their intervals, each of which holds few."""
    distinct = _inside(numbers, intervals).groupBy("interval", "value").agg(F.count("*").alias("times"))
    order = Window.partitionBy("interval").orderBy("value")
    ranked = distinct.withColumn("upto", F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    local = [(n, r - i.below, i.column, r) for n, i in enumerate(intervals) for r in i.ranks]
    targets = numbers.sparkSession.createDataFrame(local, "interval int, local bigint, column int, rank bigint")
    hit = (F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("times"))
    # two ranks per wanted quantile, so this side has a fixed bound
    rows = ranked.join(F.broadcast(targets), "interval").where(hit).select("column", "rank", "value").collect()
    return {(row["column"], row["rank"]): row["value"] for row in rows}
