"""Exact percentiles at any size.

The built-in exact ``percentile`` keeps every distinct value of a column in one task. Here one
bounded sketch per column, all in one scan, names values close to the wanted ranks. They cut the
column into intervals; the next scan counts the intervals and lists the values of those that must
hold a wanted rank, which then is a running sum away. Copies of one value are counted, never
listed, so a value that fills a third of the column costs nothing.

So two scans serve any number of columns and shares up to about 1.4e8 values a column. Beyond, a
scan of sketches within the intervals comes between, which each time allows 140 times as many. A
sketch may err; every position is counted, so that only costs a scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as fx

SKETCH_SIZE = 4_096
SLACK = 0.003  # more than twice the rank error of such a sketch at 99 %
GRID = 2_048  # quantiles that are read from a sketch
LEAF_ROWS = 1_000_000  # most values, as expected, between the ends that are listed for a position
FEW_ROWS = 10_000  # intervals of no more values are listed whole


@dataclass(frozen=True)
class Rank:
    """Position ``first + fraction`` (zero-based) among the sorted values."""

    share: float
    first: int
    fraction: float

    @property
    def last(self) -> int:
        return self.first + (1 if self.fraction > 0 else 0)


def _rank(share: float, n: int) -> Rank:
    position = (n - 1) * share
    return Rank(share, math.floor(position), position - math.floor(position))


@dataclass(frozen=True)
class Interval:
    """Values of a column between two neighbouring ends, and the positions wanted among them.

    ``low`` and ``high`` are its least and greatest value, ``near`` the sketch's values on both
    sides of each position.
    """

    column: str
    start: int  # values of the column before it
    n: int
    low: float
    high: float
    near: dict[int, tuple[float, float]]


def _number(name: str) -> Column:
    value = fx.quoted(name).cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def _coded(df: DataFrame, ends: Mapping[str, Sequence[float]]) -> DataFrame:
    """(c, v, code) for every value: code 2k lies just under end k of its column, code 2k + 1 equals it.

    A binary search written as one small projection per step over constant arrays, which stays
    cheap in generated code however many ends there are.
    """
    sizes = [len(e) for e in ends.values()]
    steps = max(sizes).bit_length()
    size = 2 ** steps
    table = F.array(*[F.lit(np.array([*e, *[math.inf] * (size - len(e))], np.float64)) for e in ends.values()])
    pairs = [F.struct(F.lit(i).alias("c"), _number(c).alias("v")) for i, c in enumerate(ends)]
    rows = df.select(F.inline(F.array(*pairs))).filter("v IS NOT NULL").select("c", "v", F.lit(0).alias("k"))
    def end(k: Column) -> Column:
        return F.get(F.get(table, F.col("c")), k)
    for step in (2 ** s for s in reversed(range(steps))):
        under = F.when(end(F.col("k") + (step - 1)) < F.col("v"), step).otherwise(0)
        rows = rows.select("c", "v", (F.col("k") + under).alias("k"))
    known = F.col("k") < F.get(F.array(*[F.lit(n) for n in sizes]), F.col("c"))
    equal = (known & (end(F.col("k")) == F.col("v"))).cast("int")
    return rows.select("c", "v", (F.col("k") * 2 + F.coalesce(equal, F.lit(0))).alias("code"))


def _wanted(shares: Mapping[str, Sequence[float]], total: Column) -> Column:
    """The positions of a row's column: both neighbours of each share."""
    table = F.array(*[F.lit(np.array(own, np.float64)) for own in shares.values()])
    places = F.transform(F.get(table, F.col("c")), lambda s: (total - 1).cast("double") * s)
    both = F.transform(places, lambda p: F.array(F.floor(p).cast("bigint"), F.ceil(p).cast("bigint")))
    return F.array_sort(F.array_distinct(F.flatten(both)))


def _intervals(df: DataFrame, ends: Mapping[str, Sequence[float]], shares: Mapping[str, Sequence[float]]) -> tuple[list[Interval], dict[str, int]]:
    """One scan: the intervals that hold a wanted position, and the number of values of each column."""
    grid = F.lit(np.arange(GRID + 1) / GRID)
    counted = (
        _coded(df, ends)
        .groupBy("c", "code")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.kll_sketch_agg_double("v", SKETCH_SIZE).alias("sketch"),
        )
    )
    own = Window.partitionBy("c")
    before = own.orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")), "total": F.sum("n").over(own)})
    inside = F.filter(_wanted(shares, F.col("total")), lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("n")))
    placed = placed.withColumn("asked", inside).filter(F.size("asked") > 0)
    read = placed.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", grid))
    def at(p: Column, side: int) -> Column:
        place = (p - F.col("start")) / F.greatest(F.col("n") - 1, F.lit(1)) + side * SLACK
        step = F.floor(place * GRID) if side < 0 else F.ceil(place * GRID)
        return F.get("grid", F.least(F.greatest(step, F.lit(0)), F.lit(GRID)).cast("int"))
    near = F.transform("asked", lambda p: F.struct(p.alias("p"), at(p, -1).alias("low"), at(p, 1).alias("high")))
    rows = read.select("c", "start", "n", "low", "high", "total", near.alias("near")).collect()
    names = list(ends)
    found = [Interval(names[r["c"]], r["start"], r["n"], r["low"], r["high"], {x["p"]: (x["low"], x["high"]) for x in r["near"]}) for r in rows]
    return found, {names[r["c"]]: r["total"] for r in rows}


def _listed(df: DataFrame, ends: Mapping[str, Sequence[float]], asked: Mapping[str, Mapping[int, Sequence[int]]]) -> dict[tuple[str, int], float]:
    """One scan: the values at the positions that are asked of the codes of each column, where they lie there."""
    tables = [[np.array(asked[c].get(code, []), np.int64) for code in range(2 * len(own) + 1)] for c, own in ends.items()]
    flags = F.array(*[F.lit(np.array([len(a) > 0 for a in own], np.int32)) for own in tables])
    listed = F.get(F.get(flags, F.col("c")), F.col("code")) == 1
    # values outside fold into one row per interval; a filter here would be pushed through the
    # search steps and multiply them
    counted = (
        _coded(df, ends)
        .select("c", "code", F.when(listed, F.col("v")).alias("v"))
        .groupBy("c", "code", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("c").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("c", "code")
        .agg(F.sum("n").alias("held"))
        .select("c", "code", F.coalesce(F.sum("held").over(before), F.lit(0).cast("bigint")).alias("start"))
    )
    upto = Window.partitionBy("c", "code").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    # all positions of a column in one array, and where those of each code begin
    flat = F.array(*[F.lit(np.concatenate(own)) for own in tables])
    begins = F.array(*[F.lit(np.cumsum([0, *map(len, own)])) for own in tables])
    begin = F.get(F.get(begins, F.col("c")), F.col("code"))
    many = F.get(F.get(begins, F.col("c")), F.col("code") + 1) - begin
    places = F.slice(F.get(flat, F.col("c")), begin.cast("int") + 1, many.cast("int"))
    held = F.filter(places, lambda p: (p < F.col("upto")) & (p >= F.col("upto") - F.col("n")))
    hits = (
        counted.withColumn("within", F.sum("n").over(upto))
        .join(starts, ["c", "code"])
        .withColumn("upto", F.col("start") + F.col("within"))
        .filter("v IS NOT NULL")
        .select("c", "v", F.explode(held).alias("p"))
        .collect()
    )
    names = list(ends)
    return {(names[h["c"]], h["p"]): h["v"] for h in hits}


def _between(low: float, high: float, fraction: float) -> float:
    """Linear interpolation that returns ``low`` untouched when both ends are equal."""
    if fraction == 0 or low == high:
        return low
    return low + (high - low) * fraction if fraction < 0.5 else high - (high - low) * (1 - fraction)


def exact_percentiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Linear-interpolation percentiles (shares in [0, 1]) per column, nulls and NaN skipped."""
    wanted = {c: list(p) for c, p in wanted.items() if p}
    if not wanted:
        return {}
    source = df.select(*[fx.quoted(c) for c in wanted])
    ends: dict[str, list[float]] = {c: [] for c in wanted}
    open_shares = {c: list(dict.fromkeys(p)) for c, p in wanted.items()}
    totals: dict[str, int] = {}
    values: dict[tuple[str, int], float] = {}  # by column and position
    while any(open_shares.values()):
        found, counted = _intervals(source, ends, open_shares)
        totals = totals or counted
        brackets: dict[tuple[str, int], tuple[float, float]] = {}
        largest = 0.0
        for i in found:
            for p, near in i.near.items():
                if i.low == i.high or p == i.start:
                    values[(i.column, p)] = i.low
                elif p == i.start + i.n - 1:
                    values[(i.column, p)] = i.high
                elif i.n <= min(FEW_ROWS, LEAF_ROWS):
                    brackets[(i.column, p)] = (i.low, i.high)
                else:
                    brackets[(i.column, p)] = near
                    largest = max(largest, 2 * (SLACK + 1 / GRID) * i.n)
        points = {c: sorted({*own, *(x for (b, _), pair in brackets.items() if b == c for x in pair)}) for c, own in ends.items()}
        if brackets and largest <= LEAF_ROWS:
            asked: dict[str, dict[int, list[int]]] = {c: {} for c in ends}
            codes = {c: {x: 2 * k + 1 for k, x in enumerate(own)} for c, own in points.items()}
            for (c, p), (low, high) in sorted(brackets.items()):
                for code in range(codes[c][low], codes[c][high] + 1):
                    asked[c].setdefault(code, []).append(p)
            values |= _listed(source, points, asked)
        ends = points
        open_shares = {
            c: [s for s in own if c in totals and not {(c, _rank(s, totals[c]).first), (c, _rank(s, totals[c]).last)} <= values.keys()]
            for c, own in open_shares.items()
        }
    answers = {}
    for c, shares in wanted.items():
        ranks = [_rank(s, totals[c]) for s in shares] if c in totals else []
        answers[c] = [_between(values[(c, r.first)], values[(c, r.last)], r.fraction) for r in ranks] or [None] * len(shares)
    return answers
