"""Exact quantiles of many keys without holding a key's values in one task.

A target is the value at one rank. Each round asks a mergeable sketch for pivots of the interval that a target lies in, and counts exactly how
many values lie below, at and between the two pivots around it, so a target is found or its interval shrinks, whatever the sketch's error is.
Once an interval holds at most ``SMALL`` values, its different values are counted and summed up in order. A value that many rows share is
counted at a pivot or as one row, so it never grows a task. The driver keeps one row per target and the pivots of its interval.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

c = F.col
#: Values of an interval that are put in order in one task, pivots a round, and the sketch's accuracy.
SMALL, PIVOTS, ACCURACY = 100_000, 256, 10_000


@dataclass
class Target:
    """The value at ``rank`` of ``key`` lies strictly between ``low`` and ``high``; ``before`` values do so below the interval, ``size`` in it."""

    key: int
    rank: int
    size: int
    before: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def interval(self) -> tuple:
        return self.key, self.low, self.high


def exact_quantiles(rows: DataFrame, key: str, value: str, fractions: Sequence[float], small: int = SMALL) -> DataFrame:
    """(key, q): per key the exact quantiles, interpolated between neighbours. ``key`` is an integer of few values; null values do not count.

    Starts jobs: one pass for the counts, two a round (a round leaves about a sixtieth), one at the end. ``rows`` should be a stored table.
    """
    values = rows.where(c(value).isNotNull()).select(c(key).cast("int").alias("k"), c(value).cast("double").alias("v"))
    sizes = {r.k: r.n for r in values.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    targets = {}
    for k, n in sizes.items():
        for fraction in fractions:
            for rank in _neighbours(n, fraction):
                targets[k, rank] = Target(k, rank, n)
    while True:
        wide = [t for t in targets.values() if t.value is None and t.size > small]
        if not wide:
            break
        _narrow(values, wide)
    _finish(values, [t for t in targets.values() if t.value is None])
    found = [(k, [_between(n, f, targets, k) for f in fractions]) for k, n in sorted(sizes.items())]
    return rows.sparkSession.createDataFrame(found, f"`{key}` int, q array<double>")


def _neighbours(n: int, fraction: float) -> tuple[int, int]:
    place = (n - 1) * fraction
    return math.floor(place), math.ceil(place)


def _between(n: int, fraction: float, targets: dict, key: int) -> float:
    low, high = _neighbours(n, fraction)
    a, b, place = targets[key, low].value, targets[key, high].value, (n - 1) * fraction
    return a if low == high or a == b else (high - place) * a + (place - low) * b


def _inside(values: DataFrame, intervals: Sequence[tuple]) -> DataFrame:
    """Values with ``i``, the number of each interval they lie in. There are at most as many intervals as targets."""
    spans = values.sparkSession.createDataFrame([(i, *span) for i, span in enumerate(intervals)], "i int, k int, low double, high double")
    held = (c("low").isNull() | (c("v") > c("low"))) & (c("high").isNull() | (c("v") < c("high")))
    return values.join(F.broadcast(spans), "k").where(held).select("i", "v")


def _narrow(values: DataFrame, wide: list[Target]) -> None:
    intervals = list(dict.fromkeys(t.interval for t in wide))
    inside = _inside(values, intervals)
    grid = F.array(*[F.lit(p / PIVOTS) for p in range(PIVOTS + 1)])
    pivots = {r.i: r.p for r in inside.groupBy("i").agg(F.percentile_approx("v", grid, F.lit(ACCURACY)).alias("p")).collect()}
    cuts = {}
    for t in wide:
        i = intervals.index(t.interval)
        place = (t.rank - t.before) / t.size * PIVOTS
        cuts[t.key, t.rank] = i, pivots[i][max(0, math.floor(place) - 1)], pivots[i][min(PIVOTS, math.ceil(place) + 1)]
    pairs = list(dict.fromkeys(cuts.values()))
    table = values.sparkSession.createDataFrame([(j, *pair) for j, pair in enumerate(pairs)], "j int, i int, a double, b double")
    counted = inside.join(F.broadcast(table), "i").groupBy("j").agg(
        F.count_if(c("v") < c("a")).alias("below"), F.count_if(c("v") == c("a")).alias("at_a"),
        F.count_if((c("v") > c("a")) & (c("v") < c("b"))).alias("within"), F.count_if((c("v") == c("b")) & (c("b") > c("a"))).alias("at_b"))
    counts = {pairs[r.j]: r for r in counted.collect()}
    for t in wide:
        cut = cuts[t.key, t.rank]
        _, a, b = cut
        n, place = counts[cut], t.rank - t.before
        steps = ((n.below, t.low, a), (n.at_a, a, a), (n.within, a, b), (n.at_b, b, b), (None, b, t.high))
        passed = 0
        for size, low, high in steps:
            size = t.size - passed if size is None else size
            if place < passed + size:
                break
            passed += size
        if low is not None and low == high:
            t.value = low
        t.before, t.size, t.low, t.high = t.before + passed, size, low, high


def _finish(values: DataFrame, rest: list[Target]) -> None:
    if not rest:
        return
    intervals = list(dict.fromkeys(t.interval for t in rest))
    different = _inside(values, intervals).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = different.withColumn("upto", F.sum("n").over(Window.partitionBy("i").orderBy("v")))
    asked = [(j, intervals.index(t.interval), t.rank - t.before) for j, t in enumerate(rest)]
    table = values.sparkSession.createDataFrame(asked, "j int, i int, place bigint")
    hit = upto.join(F.broadcast(table), "i").where((c("upto") > c("place")) & (c("upto") - c("n") <= c("place")))
    for r in hit.select("j", "v").collect():
        rest[r.j].value = r.v
