"""Mutual information by nearest neighbours (Kraskov, Stoegbauer and Grassberger, 2004), distributed.

For every row, r is the distance to its k-th nearest other row in the plane of feature and target,
the larger of the two coordinate distances. With a and b the numbers of rows closer than r in either
coordinate alone, itself included, the information is psi(N) + psi(k) - mean(psi(a) + psi(b)).

* Coordinates are divided by their deviation and become 64-bit integers, so that all distances are
  exact. Equal points are one point with a count; nothing is broken up by random noise, and rows of
  which more than k are equal count what equals them.
* The plane is cut into cells of bounded size, strips of the feature and pieces of the target in each
  strip, by quantiles. A task finds the k-th neighbours within its cell by a tree of small leaves.
  Points whose distance reaches over the cell's border visit the cells it reaches, and the k
  smallest distances of all visits count.
* Counts in one coordinate are differences of ranks: values and interval ends are sorted together by
  range partitions, and partial counts of partitions give the ranks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import columns as fx
from ..session import scratch_path

CELL = 50_000  # points of a cell, about
LEAF = 64  # points of a leaf of the tree within a cell
STEPS = 2.0**32  # integer steps of one deviation
FAR = 2**62


def _kept(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def unit(deviation: float | None) -> float:
    """The deviation in four digits, so that it does not depend on how it was summed; 1 for a constant."""
    return float(f"{deviation:.4g}") if deviation else 1.0


def digamma(n: Column) -> Column:
    """psi of a positive integer column."""
    x = n.cast("double") + 6
    far = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x**4) - 1 / (252 * x**6)
    return far - sum(1 / (n.cast("double") + i) for i in range(6))


# --- k-th neighbours within a cell ------------------------------------------------------------


def leaves_of(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Groups of at most LEAF points, by halving the wider side."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            out.append(own)
            continue
        sides = [v[own] for v in (x, y)]
        wide = max(sides, key=lambda v: int(v.max()) - int(v.min()))
        order = np.argsort(wide, kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return out


def kth_distances(qx: np.ndarray, qy: np.ndarray, x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distances from each query to the points, in order; FAR where there are fewer.

    A query that is itself one of the points finds itself at distance 0.
    """
    out = np.full((len(qx), k), FAR, np.int64)
    if not len(x) or not len(qx):
        return out
    groups, asked = leaves_of(x, y), leaves_of(qx, qy)
    box = np.array([[x[g].min(), x[g].max(), y[g].min(), y[g].max()] for g in groups])
    for own in asked:
        ax, ay = qx[own], qy[own]
        # leaves by their distance to this group of queries; done when none can be nearer
        gap = np.maximum(np.maximum(box[:, 0] - ax.max(), ax.min() - box[:, 1]), np.maximum(box[:, 2] - ay.max(), ay.min() - box[:, 3]))
        best = np.full((len(own), k), FAR, np.int64)
        order = np.argsort(gap, kind="stable")
        at = 0
        while at < len(order) and gap[order[at]] <= best[:, -1].max():
            some = np.concatenate([groups[i] for i in order[at : at + 4]])
            distance = np.maximum(np.abs(ax[:, None] - x[some]), np.abs(ay[:, None] - y[some]))
            both = np.concatenate([best, distance], axis=1)
            best = np.sort(np.partition(both, k - 1, axis=1)[:, :k], axis=1)
            at += 4
        out[own] = best
    return out


def repeated(x: np.ndarray, y: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Points as often as they count, up to k + 1 times."""
    times = np.minimum(n, k + 1)
    return np.repeat(x, times), np.repeat(y, times)


def _nearest(k: int, guests: bool):
    """The k smallest distances to other points of the cell, of its own points or of its guests."""

    def nearest(key, table):
        home = table["home"].to_numpy(zero_copy_only=False)
        x, y, n, ids = (table[c].to_numpy() for c in ("x", "y", "n", "id"))
        px, py = repeated(x[home], y[home], n[home], k)
        asked = ~home if guests else home
        # a point of the cell finds itself first, and leaves that out
        found = kth_distances(x[asked], y[asked], px, py, k if guests else k + 1)
        return pa.table([pa.array(ids[asked]), pa.array((found if guests else found[:, 1:]).tolist(), pa.list_(pa.int64()))], names=["id", "distances"])

    return nearest


NEAREST = "id long, distances array<long>"


# --- cells --------------------------------------------------------------------------------


class Cells:
    """Strips of x by feature, and pieces of y by strip; edges begin the next strip or piece."""

    def __init__(self, strips: list[list[int]], pieces: list[list[list[int]]]) -> None:
        self.strips = [np.array(s, np.int64) for s in strips]
        self.pieces = [[np.array(p, np.int64) for p in of] for of in pieces]
        sizes = [len(p) + 1 for of in pieces for p in of]
        firsts = list(accumulate(sizes, initial=0))
        counts = list(accumulate((len(of) for of in pieces), initial=0))
        self.first = [np.array(firsts[counts[f] : counts[f + 1]]) for f in range(len(pieces))]

    def of(self, feature: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        strip = np.searchsorted(self.strips[feature], x, side="right")
        out = np.zeros(len(x), np.int64)
        for s in np.unique(strip):
            own = strip == s
            out[own] = self.first[feature][s] + np.searchsorted(self.pieces[feature][s], y[own], side="right")
        return out

    def reached(self, feature: int, x: int, y: int, r: int) -> list[int]:
        """All cells within r of a point."""
        low, high = np.searchsorted(self.strips[feature], [x - r, x + r], side="right")
        out = []
        for s in range(low, high + 1):
            a, b = np.searchsorted(self.pieces[feature][s], [y - r, y + r], side="right")
            out += range(self.first[feature][s] + a, self.first[feature][s] + b + 1)
        return out


def _celled(cells: Cells):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, x, y = (batch[c].to_numpy() for c in ("feature", "x", "y"))
            cell = np.zeros(len(x), np.int64)
            for f in np.unique(feature):
                own = feature == f
                cell[own] = cells.of(int(f), x[own], y[own])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return place


def _visits(cells: Cells):
    """Points whose k-th distance reaches other cells, once for each of those."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, to = [], []
            columns = [batch[c].to_numpy() for c in ("feature", "x", "y", "r", "cell")]
            for i, (f, x, y, r, cell) in enumerate(zip(*[c.tolist() for c in columns])):
                # with too few points in the own cell, every cell of the feature may hold a neighbour
                for c in cells.reached(f, x, y, r):
                    if c != cell:
                        rows.append(i)
                        to.append(c)
            part = batch.select(["id", "x", "y", "n"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(to, pa.int64())], names=["id", "x", "y", "n", "cell"])

    return visit


def cells_for(points: DataFrame, features: int, cell: int) -> Cells:
    """Cells of about ``cell`` points: as many strips as pieces in each."""
    sizes = {r["feature"]: r["n"] for r in points.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    across = {f: max(1, round((n / cell) ** 0.5)) for f, n in sizes.items()}
    shares = sorted({(i, a) for a in across.values() for i in range(1, a)})
    strips: list[list[int]] = [[] for _ in range(features)]
    if shares:
        parts = [i / a for i, a in shares]
        found = points.groupBy("feature").agg(F.percentile_approx("x", parts, 10 * len(parts) + 10_000).alias("q")).collect()
        for r in found:
            strips[r["feature"]] = sorted({q for q, (_, a) in zip(r["q"], shares) if a == across[r["feature"]]})
    edge = F.array(*[F.array(*[F.lit(e).cast("long") for e in s]).cast("array<bigint>") for s in strips])
    strip = F.size(F.filter(F.get(edge, F.col("feature")), lambda e: e <= F.col("x")))
    cut = points.withColumn("strip", strip).groupBy("feature", "strip")
    wanted = {(r["feature"], r["strip"]): max(1, round(r["count"] / cell)) for r in cut.count().collect()}
    pieces: list[list[list[int]]] = [[[] for _ in range(len(s) + 1)] for s in strips]
    most = max(wanted.values(), default=1)
    if most > 1:
        steps = [i / most for i in range(1, most)]
        for r in cut.agg(F.percentile_approx("y", steps, 10 * most + 10_000).alias("q")).collect():
            n = wanted[r["feature"], r["strip"]]
            pieces[r["feature"]][r["strip"]] = sorted({r["q"][max(0, round(i * most / n) - 1)] for i in range(1, n)})
    return Cells(strips, pieces)


# --- ranks --------------------------------------------------------------------------------


def counts_within(spark: SparkSession, points: DataFrame) -> DataFrame:
    """(id, nx, ny): rows of the point's feature closer than r in x or y, or equal where r is 0.

    Values and ends of intervals are sorted together; what comes before an end is its rank.
    """
    reach = F.greatest(F.col("r") - 1, F.lit(0))

    def events(dim: int, value: Column) -> list[Column]:
        # at equal places values come first, so an end counts what is at most there
        return [
            F.struct(F.lit(dim).alias("dim"), value.alias("at"), F.lit(0).alias("kind"), F.col("n").alias("adds"), F.lit(0).cast("long").alias("sign")),
            F.struct(F.lit(dim).alias("dim"), (value + reach).alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("adds"), F.lit(1).cast("long").alias("sign")),
            F.struct(F.lit(dim).alias("dim"), (value - reach - 1).alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("adds"), F.lit(-1).cast("long").alias("sign")),
        ]

    rows = points.select("feature", "id", F.explode(F.array(*events(0, F.col("x")), *events(1, F.col("y")))).alias("e")).select("feature", "id", "e.*")
    order = ["feature", "dim", "at", "kind", "id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ranged = _kept(spark, ranged, "events").withColumn("file", F.shiftright("place", 33))
    column = ["feature", "dim"]
    totals = ranged.groupBy(*column, "file").agg(F.sum("adds").alias("held"))
    earlier = Window.partitionBy(*column).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*[F.col(c).alias(f"b_{c}") for c in [*column, "file"]], F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy(*column, "file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("upto", F.sum("adds").over(upto)).where("sign <> 0")
    joined = local.join(before, (F.col("feature") == F.col("b_feature")) & (F.col("dim") == F.col("b_dim")) & (F.col("file") == F.col("b_file")))
    rank = F.col("sign") * (F.col("upto") + F.col("before"))
    return joined.groupBy("id").agg(*[F.sum(F.when(F.col("dim") == d, rank)).alias(n) for d, n in enumerate(("nx", "ny"))])


def neighbour_information(df: DataFrame, target: str, columns: Sequence[str] | None = None, k: int = 3, cell: int = CELL) -> DataFrame:
    """(feature, mi) in nats, not below 0; null for a feature with at most k rows.

    Rows where feature or target is missing take no part in that feature.
    """
    spark = df.sparkSession
    names = [c for c in fx.present(df, columns or fx.numeric_columns(df)) if c != target]
    schema = "feature string, mi double"
    if not names:
        return spark.createDataFrame([], schema)
    values = {c: fx.known(df, c).cast("double") for c in [*names, target]}
    both = {c: values[c].isNotNull() & values[target].isNotNull() for c in names}
    measured = df.agg(*[F.stddev_pop(F.when(both[c], values[v])).alias(f"{p}{i}") for i, c in enumerate(names) for p, v in (("x", c), ("y", target))]).first()

    def steps(value: Column, deviation: float | None) -> Column:
        return F.rint(value / F.lit(unit(deviation)) * F.lit(STEPS)).cast("long")

    pairs = [F.struct(F.lit(i).alias("feature"), steps(values[c], measured[f"x{i}"]).alias("x"), steps(values[target], measured[f"y{i}"]).alias("y")) for i, c in enumerate(names)]
    long = df.select(F.inline(F.array(*pairs))).where("x IS NOT NULL AND y IS NOT NULL")
    points = long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id())
    points = _kept(spark, points, "points")
    cells = cells_for(points, len(names), cell)
    placed = points.mapInArrow(_celled(cells), T.StructType([*points.schema.fields, T.StructField("cell", T.LongType())]))
    placed = _kept(spark, placed, "cells")
    home = placed.select("cell", "id", "x", "y", "n", F.lit(True).alias("home"))
    found = _kept(spark, home.groupBy("cell").applyInArrow(_nearest(k, False), NEAREST), "nearest")
    first = found.select(F.col("id").alias("of"), F.element_at("distances", -1).alias("r"))
    reaching = placed.join(first, F.col("id") == F.col("of")).drop("of")
    visits = _kept(spark, reaching.mapInArrow(_visits(cells), "id long, x long, y long, n long, cell long"), "visits")
    guests = visits.select("cell", "id", "x", "y", "n", F.lit(False).alias("home"))
    met = home.join(visits.select("cell").distinct(), "cell", "left_semi").unionByName(guests)
    further = met.groupBy("cell").applyInArrow(_nearest(k, True), NEAREST)
    merged = found.unionByName(further).groupBy("id").agg(F.get(F.array_sort(F.flatten(F.collect_list("distances"))), k - 1).alias("r"))
    ready = _kept(spark, placed.join(merged.withColumnRenamed("id", "of"), F.col("id") == F.col("of")).select("feature", "id", "x", "y", "n", "r"), "distances")
    counts = counts_within(spark, ready).withColumnRenamed("id", "of")
    psi = digamma(F.col("nx")) + digamma(F.col("ny"))
    sums = ready.join(counts, F.col("id") == F.col("of")).groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * psi).alias("psi"))
    mi = F.greatest(F.lit(0.0), digamma(F.col("rows")) + digamma(F.lit(k)) - F.col("psi") / F.col("rows"))
    listed = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    return listed.join(sums, F.col("i") == F.col("feature"), "left").select(F.col("name").alias("feature"), F.when(F.col("rows") > k, mi).alias("mi"))
