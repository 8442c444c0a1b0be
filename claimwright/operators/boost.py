"""Boosted regression trees over binned rows: gradient boosting and AdaBoost.R2.

The rows are read twice. The first scan finds the cells of every feature: its distinct values, or
quantiles where there are more than ``EXACT``. The second writes each row as the numbers of its
cells, with its label and its state (the prediction so far, or the weight), in blocks of columns. A
tree then costs one scan per level: every task sums weights and targets of its rows by node, feature
and bin, the sums of the tasks (a few kilobytes each) meet on the driver, and these choose the
splits. Gradient boosting keeps its bins for all trees, so rows of a task with the same bins are one
row with their number and mean label; the sums are the same. The scan of the root also brings the
state up to date, so a round of boosting is as many scans as its trees are deep, and one more for
AdaBoost's loss.

Trees follow MLlib's rules: at most ``BINS`` bins per feature, cut between neighbouring values if
these are few and else at even steps of the rows' weight, the split with the largest decrease of the
variance, the first of equal ones by feature and bin. But the steps count all rows, where MLlib
looks at a sample of 10,000. The state is kept in the cache and every few rounds written to one of
two places in the shared folder in turn, so the plan stays short, a lost executor does not restart
the boosting, and the disk holds two copies however many rounds there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import columns as fx
from ..session import scratch_path

FEATURES, PREDICTION = "features", "prediction"
BINS = 32  # of a feature, in one tree
EXACT = 10_000  # distinct values of a feature that are cells as they are
CELLS = 2_048  # of a feature with more values
VALUES = 1 << 20  # distinct values of all features that the driver holds
BLOCK_ROWS = 1 << 15
PART_BYTES = 128 << 20  # of blocks in a partition
SUM_BYTES = 64 << 20  # of all tasks' sums in one scan
NOISE = 1e-11  # a difference of sums this small, against their terms, is rounding
SMALL = 40  # split nodes of a small tree
KEYED = 12  # features whose bins make up one 64-bit key
MERGED_ROWS = 1 << 20  # different keys that a task holds

EACH, WEIGHT, ANY = "each", "weight", "any"

BLOCKS = "codes binary, y binary, state binary"
Scan = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


# --- trees ----------------------------------------------------------------------------------


@dataclass
class Tree:
    """One tree in arrays. A leaf has feature -1; the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gains: list[float] = field(default_factory=list)  # summed decrease of the squared error by feature
    depth: int = 0
    predictionCol: str = PREDICTION

    def copy(self, extra: Mapping[str, str]) -> Tree:
        """The same tree with another prediction column, as with MLlib's models."""
        return replace(self, predictionCol=extra.get(self.predictionCol, self.predictionCol))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.predictionCol, F.get(FlatTrees.of([self]).predictions(vector_to_array(FEATURES)), F.lit(0)))


@dataclass
class FlatTrees:
    """Many small trees as one table of nodes. A leaf points to itself, so a fixed number of steps ends in it."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: list[int]
    depths: list[int]

    @classmethod
    def of(cls, trees: Sequence[Tree]) -> FlatTrees:
        starts = np.cumsum([0, *[len(t.feature) for t in trees]])
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for start, t in zip(starts, trees):
            f = np.array(t.feature)
            inner = f >= 0
            left = start + np.where(inner, np.array(t.left), np.arange(len(f)))
            for column, part in zip(columns, (np.where(inner, f, 0), np.where(inner, np.array(t.threshold), np.inf), left, np.array(t.value))):
                column.append(part)
        return cls(*[np.concatenate(c) if c else np.zeros(0) for c in columns], starts[:-1].tolist(), [t.depth for t in trees])

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf of every row in one tree after another. ``x`` holds a row per feature."""
        x = np.ascontiguousarray(x)
        for i, (root, depth) in enumerate(zip(self.roots, self.depths)):
            own = slice(root, self.roots[i + 1] if i + 1 < len(self.roots) else len(self.left))
            feature = np.where(self.left[own] > np.arange(own.start, own.stop), self.feature[own], -1)
            yield root + leaves_of(x, feature, self.threshold[own], self.left[own] - root, depth)

    def each(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The predictions of one tree after another."""
        for leaf in self.leaves(x):
            yield self.value[leaf]

    def scored(self, x: Column, kind: str, merge: Callable[[Iterator[np.ndarray], int], pa.Array], each: Callable[[np.ndarray], Iterator[np.ndarray]] | None = None) -> Column:
        """A column from all trees' predictions, or what else they give, for blocks of rows' values."""
        each = each or self.each

        @F.arrow_udf(kind)
        def score(rows: pa.Array) -> pa.Array:
            values, count = rows.flatten().to_numpy(zero_copy_only=False), len(rows)
            x = values.reshape(count, -1).T if count else np.zeros((0, 0))
            return merge(each(x), count)

        return score(x)

    def predictions(self, x: Column) -> Column:
        """The array of all trees' predictions for a row's values."""
        trees = len(self.roots)

        def listed(each: Iterator[np.ndarray], count: int) -> pa.Array:
            table = np.stack(list(each), axis=1) if trees else np.zeros((count, 0))
            return pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * trees, pa.int32()), pa.array(table.ravel()))

        return self.scored(x, "array<double>", listed)

    def sums(self, x: Column, weights: Sequence[float]) -> Column:
        """The weighted sum of the trees' predictions."""

        def summed(each: Iterator[np.ndarray], count: int) -> pa.Array:
            total = np.zeros(count)
            for weight, p in zip(weights, each):
                total += weight * p
            return pa.array(total)

        return self.scored(x, "double", summed)

    def medians(self, x: Column, weights: Sequence[float]) -> Column:
        """The weighted median: the first prediction, from below, at which half of the weight is reached."""
        half = sum(weights) / 2
        rising = np.argsort(self.value, kind="stable")  # leaves by value: a row's are sorted as whole numbers
        rank = np.empty(len(rising), np.int32)
        rank[rising] = np.arange(len(rising))
        tree = np.searchsorted(self.roots, rising, side="right") - 1
        weight_of, value_of = np.asarray(weights)[tree], self.value[rising]

        def middle(each: Iterator[np.ndarray], count: int) -> pa.Array:
            table = np.stack([rank[leaf] for leaf in each], axis=1)
            table.sort(axis=1)
            reached = np.cumsum(weight_of[table], axis=1) >= half
            pick = np.where(reached[:, -1], reached.argmax(axis=1), table.shape[1] - 1)
            return pa.array(value_of[table[np.arange(count), pick]])

        return self.scored(x, "double", middle, self.leaves)


def leaves_of(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Where every row has come to after ``depth`` steps; up to the cut it goes left. A leaf has feature -1.

    In a small tree each node moves its rows by comparing its whole column, without looking anything up.
    """
    inner = np.flatnonzero(feature >= 0)
    if len(inner) <= SMALL:
        node = np.zeros(columns.shape[1], np.int16)
        for k, f, at, child in zip(inner.tolist(), feature[inner], cut[inner].tolist(), left[inner].tolist()):  # children come after their parents
            node += ((columns[f] > at) + np.int16(child - k)) * (node == k)
        return node
    rows, flat, node = np.arange(columns.shape[1]), columns.ravel(), np.zeros(columns.shape[1], np.int64)
    offset, left = np.maximum(feature, 0) * columns.shape[1], np.where(feature >= 0, left, np.arange(len(left)))
    for _ in range(depth):
        node = left[node] + ((flat[offset[node] + rows] > cut[node]) & (feature[node] >= 0))
    return node


# --- cells and blocks -----------------------------------------------------------------------


@dataclass
class Cells:
    """The cells of every feature by their largest value; cell i holds what lies above value i - 1, up to value i."""

    values: list[np.ndarray]
    exact: list[bool]  # every cell is one value


def distinct_values(rows: DataFrame, features: int) -> list[np.ndarray | None]:
    """The sorted distinct values of every feature, or None where there are more than fit."""
    most = max(BINS + 1, min(EXACT, VALUES // max(1, features)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.zeros(0) for _ in range(features)]
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            if not np.isfinite(x).all():
                raise ValueError("features must not be NaN or infinite")
            for f, known in enumerate(seen):
                if known is not None:
                    known = np.union1d(known, x[:, f] + 0.0)
                    seen[f] = known if len(known) <= most else None
        for f, known in enumerate(seen):
            found = known if known is not None else np.full(1, np.nan)  # stands for too many
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), f, np.int32)), pa.array(found)], names=["f", "v"])

    found = rows.select("x").mapInArrow(scan, "f int, v double").distinct()
    kept = F.when(F.count(F.when(F.isnan("v"), 1)) + F.greatest(F.count("v") - most, F.lit(0)) == 0, F.array_sort(F.collect_list("v")))
    by_feature = {r["f"]: r["v"] for r in found.groupBy("f").agg(kept.alias("v")).collect()}
    return [None if by_feature.get(f) is None else np.array(by_feature[f]) for f in range(features)]


def cells_of(rows: DataFrame, features: int) -> Cells:
    values = distinct_values(rows, features)
    many = [f for f, v in enumerate(values) if v is None]
    if many:
        shares = [k / CELLS for k in range(1, CELLS)] + [1.0]
        found = rows.agg(*[F.percentile_approx(F.get("x", f), shares, 5 * CELLS).alias(f"q{f}") for f in many]).first()
        for f in many:
            values[f] = np.unique(found[f"q{f}"])
    return Cells(values, [f not in many for f in range(features)])


def blocks_of(rows: DataFrame, cells: Cells, state: float | None, count: int) -> DataFrame:
    """The rows as blocks of columns, spread evenly over all cores and cached. Without a ``state`` it is the row's own number."""
    edges, features = cells.values, len(cells.values)
    spark = rows.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        own = TaskContext.get().partitionId() << 32  # numbers below 2^53 are exact

        def block() -> pa.RecordBatch:
            nonlocal own
            table = pa.Table.from_batches(held).combine_chunks()
            x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, features)
            codes = np.empty((features, table.num_rows), np.uint16)
            for f in range(features):  # the last cell also takes what a sketch left above it
                codes[f] = np.minimum(np.searchsorted(edges[f], x[:, f]), len(edges[f]) - 1)
            own += table.num_rows
            states = np.arange(own - table.num_rows, own, dtype=np.float64) if state is None else np.full(table.num_rows, state)
            return block_batch(codes, table["y"].to_numpy(), states)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block()
                held.clear()
        if sum(b.num_rows for b in held):
            yield block()

    cores, size = spark.sparkContext.defaultParallelism, count * (2 * features + 16)
    parts = max(1, min(math.ceil(count / BLOCK_ROWS), max(cores, math.ceil(size / PART_BYTES))))
    return rows.mapInArrow(write, BLOCKS).repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)


def block_batch(codes: np.ndarray, y: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (codes, y, state)], names=["codes", "y", "state"])


def arrays_of(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes by feature, labels and states of one block after another."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes, y, state = (np.frombuffer(batch[c][i].as_buffer(), t) for c, t in (("codes", kind), ("y", np.float64), ("state", np.float64)))
            yield codes.reshape(-1, len(y)) if len(y) else codes.reshape(0, 0), y, state


def keys_of(bins: np.ndarray) -> np.ndarray:
    """One number for the bins of all features of a row."""
    keys = np.zeros(bins.shape[1], np.int64)
    for b in bins:
        keys *= BINS
        keys += b
    return keys


def bins_of(keys: np.ndarray, features: int) -> np.ndarray:
    return np.stack([(keys // BINS**f % BINS).astype(np.uint8) for f in reversed(range(features))])


class Merger:
    """Sums by key of what comes in pieces: one column per key, one row per sum."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.kept = 0

    def add(self, keys: np.ndarray, sums: np.ndarray) -> None:
        self.held.append((keys, sums))
        self.size += len(keys)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        sums = np.zeros((len(self.held[0][1]), len(keys)))
        at = 0
        for k, part in self.held:  # the keys of a piece are distinct
            sums[:, place[at : at + len(k)]] += part
            at += len(k)
        self.held, self.size, self.kept = [(keys, sums)], len(keys), len(keys)
        return keys, sums

    def full(self, most: int) -> bool:
        """Whether more than ``most`` different keys are held; pieces are merged once they are as large again."""
        if self.size > self.kept + most:
            self.merge()
        return self.kept > most


def summed(blocks: DataFrame, kind: type, scan: Scan) -> list[np.ndarray]:
    """What ``scan`` gives, added up over the blocks of each task; by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for arrays in arrays_of(batches, kind):
            found = scan(*arrays)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    found = sorted(blocks.mapInArrow(run, "part int, sums binary").collect())
    return [np.frombuffer(r["sums"], np.float64) for r in found]


def renewed(blocks: DataFrame, kind: type, change: Scan, recode: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """The blocks with new states and, perhaps, codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, y, state in arrays_of(batches, kind):
            yield block_batch(codes if recode is None else recode(codes), y, change(codes, y, state))

    return blocks.mapInArrow(run, BLOCKS)


# --- growing a tree -------------------------------------------------------------------------


def cuts_of(weights: np.ndarray, most: int) -> np.ndarray:
    """The cells after which a feature is cut, from the weight in each cell, by MLlib's rule."""
    full = np.flatnonzero(weights)
    if len(full) <= most:
        return full[:-1]
    upto = np.cumsum(weights[full])
    stride, twice = upto[-1] / most, upto[:-1] + upto[1:]
    found, at, step = [], 0, 1
    while at < len(twice):
        at = max(at, int(np.searchsorted(twice, 2 * stride * step, side="right")))
        if at < len(twice):
            found.append(full[at])
        at, step = at + 1, step + 1
    return np.array(found, np.int64)


def thresholds_of(cells: Cells, weights: np.ndarray, f: int, cuts: np.ndarray) -> list[float]:
    """Between the cells beside each cut that hold any weight."""
    full = np.flatnonzero(weights)
    above = full[np.searchsorted(full, cuts, side="right")]
    v = cells.values[f]
    return [float((v[a] + v[b]) / 2 if cells.exact[f] else v[a]) for a, b in zip(cuts, above)]


@dataclass
class Binned:
    """The bins of one tree: which bin each cell is in, and the thresholds between bins."""

    bin_of: list[np.ndarray]
    thresholds: list[list[float]]

    @classmethod
    def of(cls, cells: Cells, weights: list[np.ndarray], most: int) -> Binned:
        cuts = [cuts_of(w, most) for w in weights]
        bins = [np.searchsorted(c, np.arange(len(w))).astype(np.uint8) for c, w in zip(cuts, weights)]
        return cls(bins, [thresholds_of(cells, w, f, c) for f, (c, w) in enumerate(zip(cuts, weights))])

    def codes(self, cells: np.ndarray) -> np.ndarray:
        return np.stack([b[c] for b, c in zip(self.bin_of, cells)]) if len(cells) else cells.astype(np.uint8)


@dataclass
class Shape:
    """A tree as it grows, by bins."""

    feature: np.ndarray
    cut: np.ndarray  # the last bin of the left side
    left: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Where every row has come to after ``depth`` steps."""
        return leaves_of(bins, self.feature, self.cut, self.left, depth)

    def by_cells(self, binned: Binned) -> Shape:
        """The same tree over cells: the last cell of the left side in place of the bin."""
        cut = [np.searchsorted(binned.bin_of[f], c, side="right") - 1 if f >= 0 else c for f, c in zip(self.feature, self.cut)]
        return replace(self, cut=np.array(cut))


class Grower:
    """Chooses splits level by level from sums by node, feature and bin."""

    def __init__(self, features: int, max_depth: int, min_instances: int) -> None:
        self.features, self.max_depth, self.min_instances = features, max_depth, min_instances
        self.feature, self.cut, self.left, self.value = [-1], [BINS], [0], [0.0]
        self.gains, self.depth, self.open = np.zeros(features), 0, [0]

    def shape(self) -> Shape:
        return Shape(np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.value))

    def split(self, nodes: list[int], table: np.ndarray, squares: np.ndarray) -> list[int]:
        """Splits nodes by their sums (rows, weight, target by node, feature and bin); the children to go on with."""
        upto = np.cumsum(table, axis=3)
        n, w, s = upto[0], upto[1], upto[2]
        total = upto[:, :, 0, -1]
        further = []
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = total[2] / total[1]
            right = total[1][:, None, None] - w
            off = s - w * mean[:, None, None]
            gain = off * off * (total[1][:, None, None] / (w * right))
            ok = (n >= self.min_instances) & (total[0][:, None, None] - n >= self.min_instances) & (w > 0) & (right > 0)
            ok &= np.abs(off) > NOISE * np.sqrt(total[1] * squares)[:, None, None]
        gain = np.where(ok, gain, -np.inf).reshape(len(nodes), -1)
        best = gain.argmax(axis=1)
        for i, node in enumerate(nodes):
            if node == 0:
                self.value[0] = float(mean[0])
            if not gain[i, best[i]] > 0 or not self.max_depth:
                continue
            f, b = divmod(int(best[i]), BINS)
            at = len(self.feature)
            self.feature[node], self.cut[node], self.left[node] = f, b, at
            self.gains[f] += gain[i, best[i]]
            sides = [(w[i, f, b], s[i, f, b], n[i, f, b]), (total[1, i] - w[i, f, b], total[2, i] - s[i, f, b], total[0, i] - n[i, f, b])]
            for weight, target, rows in sides:
                if rows >= 2 * self.min_instances:
                    further.append(len(self.feature))
                self.feature.append(-1)
                self.cut.append(BINS)
                self.left.append(len(self.left))
                self.value.append(float(target / weight))
        return further

    def tree(self, binned: Binned) -> Tree:
        thresholds = [binned.thresholds[f][c] if f >= 0 else 0.0 for f, c in zip(self.feature, self.cut)]
        return Tree(list(self.feature), thresholds, list(self.left), list(self.value), self.gains.tolist(), self.depth)


def some(weights: np.ndarray) -> np.ndarray:
    """Rows enough for two leaves, where there is any weight."""
    return 2.0 * (weights > 0)


def node_sums(bins: np.ndarray, place: np.ndarray, count: int, target: np.ndarray, weight: np.ndarray | None, rows: str = EACH) -> np.ndarray:
    """Rows, weight and target by node, feature and bin, then the squares by node. ``place`` is -1 for rows elsewhere.

    How many rows there are: ``EACH`` is one, as many as its ``WEIGHT`` says, or it matters only whether there are ``ANY``.
    """
    if place.min(initial=0) < 0:
        own = np.flatnonzero(place >= 0)
        bins, place, target = bins[:, own], place[own], target[own]
        weight = None if weight is None else weight[own]
    weighted = target if weight is None else weight * target
    size, base = count * BINS, place * BINS
    table = np.empty((3, count, len(bins), BINS))
    for f, b in enumerate(bins):
        key = base + b
        if rows == EACH:
            table[0, :, f] = np.bincount(key, minlength=size).reshape(count, BINS)
        table[1, :, f] = table[0, :, f] if weight is None else np.bincount(key, weight, size).reshape(count, BINS)
        if rows != EACH:
            table[0, :, f] = table[1, :, f] if rows == WEIGHT else some(table[1, :, f])
        table[2, :, f] = np.bincount(key, weighted, size).reshape(count, BINS)
    return np.concatenate([table.ravel(), np.bincount(place, weighted * target, count)])


def grow(
    blocks: DataFrame, kind: type, binned: Binned, recode: bool, features: int, max_depth: int, min_instances: int,
    target_of: Callable[[np.ndarray, np.ndarray], np.ndarray], weight_of: Callable[[np.ndarray], np.ndarray | None], parts: int, rows: str = EACH, root: np.ndarray | None = None,
) -> Grower:
    """One tree, a scan per level; levels of very many nodes take several. The sums of the ``root`` may be known."""
    grown = Grower(features, max_depth, min_instances)
    each = max(1, SUM_BYTES // (24 * max(1, features) * BINS * max(1, parts)))
    while grown.open and (grown.depth < max_depth or not grown.depth):  # the root has a value at any depth
        further: list[int] = []
        shape, depth = grown.shape(), grown.depth
        for start in range(0, len(grown.open), each):
            asked = grown.open[start : start + each]
            place_of = np.full(len(shape.feature), -1)
            place_of[asked] = np.arange(len(asked))

            def scan(codes: np.ndarray, y: np.ndarray, state: np.ndarray, place_of=place_of, count=len(asked)) -> np.ndarray:
                bins = binned.codes(codes) if recode else codes
                return node_sums(bins, place_of[shape.nodes(bins, depth)], count, target_of(y, state), weight_of(state), rows)

            total = sum(summed(blocks, kind, scan)) if depth or root is None else root
            table = total[: -len(asked)].reshape(3, len(asked), features, BINS)
            further += grown.split(asked, table, total[-len(asked) :])
        if len(grown.feature) == len(shape.feature):
            break
        grown.open, grown.depth = further, depth + 1
    return grown


class Rounds:
    """The blocks of a boosting from round to round: cached, and every few rounds written to one of two places in turn."""

    def __init__(self, blocks: DataFrame, every: int) -> None:
        self.spark, self.blocks, self.every, self.written, self.done = blocks.sparkSession, blocks, every, 0, 0
        self.places = [scratch_path(self.spark, "boosting") for _ in range(2)]
        self.older: list[DataFrame] = []

    def move(self, blocks: DataFrame) -> None:
        """Goes on with new blocks. The old ones are kept until these have been read once."""
        self.drop()
        self.older, self.done = [self.blocks], self.done + 1
        if self.done % self.every == 0:
            place = self.places[self.written % 2]
            blocks.write.mode("overwrite").parquet(place)
            blocks, self.written = self.spark.read.schema(blocks.schema).parquet(place), self.written + 1
        self.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def drop(self) -> None:
        for old in self.older:
            old.unpersist()
        self.older = []

    def close(self) -> None:
        self.drop()
        self.blocks.unpersist()


def learnt(df: DataFrame, label: str, skip_null: bool) -> tuple[DataFrame, int, int]:
    """(values and label, rows, features); labels and values must be finite."""
    y = fx.quoted(label).cast("double")
    rows = df.select(vector_to_array(FEATURES).alias("x"), y.alias("y"))
    rows = rows.where("y IS NOT NULL") if skip_null else rows
    bad = F.col("y").isNull() | F.isnan("y") | (F.abs("y") == F.lit(float("inf")))
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("features"), F.count(F.when(bad, 1)).alias("bad"), F.count("x").alias("x")
    ).first()
    if not seen["n"]:
        raise ValueError("no row with a label")
    if seen["bad"] or seen["x"] < seen["n"] or not 0 < seen["least"] == seen["features"]:
        raise ValueError("labels and features must be given and finite, and vectors of one size")
    return rows, seen["n"], seen["features"]


def cell_weights(blocks: DataFrame, cells: Cells, weight_of: Callable[[np.ndarray], np.ndarray | None]) -> list[np.ndarray]:
    """The weight in each cell of every feature."""
    starts = np.cumsum([0, *[len(v) for v in cells.values]])

    def scan(codes: np.ndarray, y: np.ndarray, state: np.ndarray) -> np.ndarray:
        weight, out = weight_of(state), np.zeros(starts[-1])
        for f, c in enumerate(codes):
            out[starts[f] : starts[f + 1]] = np.bincount(c, weight, starts[f + 1] - starts[f])
        return out

    total = sum(summed(blocks, np.uint16, scan))
    return [total[a:b] for a, b in zip(starts[:-1], starts[1:])]


def cell_sums(blocks: DataFrame, cells: Cells) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """Weights and weighted labels in each cell of every feature, and the weighted squares of all labels."""
    starts = np.cumsum([0, *[len(v) for v in cells.values]])

    def scan(codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        out, weighted = np.empty(2 * starts[-1] + 1), weight * y
        for f, c in enumerate(codes):
            c = c.astype(np.intp)
            for side, part in enumerate((weight, weighted)):
                out[side * starts[-1] + starts[f] : side * starts[-1] + starts[f + 1]] = np.bincount(c, part, starts[f + 1] - starts[f])
        out[-1] = weighted @ y
        return out

    total = sum(summed(blocks, np.uint16, scan))
    sides = [[total[at + a : at + b] for a, b in zip(starts[:-1], starts[1:])] for at in (0, starts[-1])]
    return sides[0], sides[1], total[-1]


def root_sums(binned: Binned, weights: list[np.ndarray], targets: list[np.ndarray], squares: float) -> np.ndarray:
    """The root's sums by feature and bin, from those by cell."""
    table = np.array([[np.bincount(b, v, BINS) for b, v in zip(binned.bin_of, side)] for side in (weights, targets)])
    return np.r_[some(table[0]).ravel(), table.ravel(), squares]


def unweighted(_: np.ndarray) -> None:
    return None


# --- gradient boosting ----------------------------------------------------------------------


@dataclass
class GradientBoosting:
    """Boosting of the squared error: the first tree fits the label, each further one twice what is left of it."""

    label: str
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 5
    min_instances: int = 1
    checkpoint_every: int = 10

    def fit(self, df: DataFrame) -> GradientBoostingModel:
        rows, count, features = learnt(df, self.label, False)
        cells = cells_of(rows, features)
        fine = blocks_of(rows, cells, 0.0, count)
        binned = Binned.of(cells, cell_weights(fine, cells, unweighted), min(BINS, count))
        parts = fine.rdd.getNumPartitions()
        coarse = merged_rows(fine, binned, features).persist(StorageLevel.MEMORY_AND_DISK)
        coarse.count()
        fine.unpersist()
        rounds, trees, weights = Rounds(coarse, self.checkpoint_every), [], []
        for i in range(self.rounds):
            residual = (lambda y, state: y) if i == 0 else (lambda y, state: 2 * (y - state[: len(y)]))
            grown = grow(rounds.blocks, np.uint8, binned, False, features, self.max_depth, self.min_instances, residual, lambda state: state[len(state) // 2 :], parts, WEIGHT)
            trees.append(grown.tree(binned))
            weights.append(1.0 if i == 0 else self.learning_rate)
            if i + 1 < self.rounds:
                rounds.move(renewed(rounds.blocks, np.uint8, added(grown.shape(), grown.depth, weights[-1])))
        rounds.close()
        return GradientBoostingModel(trees, weights)


def merged_rows(blocks: DataFrame, binned: Binned, features: int) -> DataFrame:
    """Rows of a task whose bins are all equal as one: its label is their mean, its state the prediction and their number.

    Every tree sees them alike, and sums over them are those over the rows. Where hardly any rows
    agree, or of more than ``KEYED`` features, it is a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(keys), BLOCK_ROWS):
                n, y = sums[:, a : a + BLOCK_ROWS]
                yield block_batch(bins_of(keys[a : a + BLOCK_ROWS], features), centre + y / n, np.r_[np.zeros(len(n)), n])

        held, centre = Merger(), None
        for codes, y, _ in arrays_of(batches, np.uint16):
            bins = binned.codes(codes)
            if features > KEYED:
                yield block_batch(bins, y, np.r_[np.zeros(len(y)), np.ones(len(y))])
                continue
            keys, place = np.unique(keys_of(bins), return_inverse=True)
            centre = y[0] if centre is None else centre  # equal labels then keep their exact value
            held.add(keys, np.stack([np.bincount(place, minlength=len(keys)), np.bincount(place, y - centre, len(keys))]))
            if held.full(MERGED_ROWS):
                yield from out(*held.merge())
                held = Merger()
        if held.size:
            yield from out(*held.merge())

    return blocks.mapInArrow(run, BLOCKS)


def added(shape: Shape, depth: int, weight: float) -> Scan:
    """States that go on by a tree's predictions."""

    def change(codes: np.ndarray, y: np.ndarray, state: np.ndarray) -> np.ndarray:
        return np.r_[state[: len(y)] + weight * shape.value[shape.nodes(codes, depth)], state[len(y) :]]

    return change


@dataclass
class Boosted:
    """Weighted trees, kept as one table of trees."""

    trees: list[Tree]
    weights: list[float]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, w, t.feature, t.threshold, t.left, t.value, t.gains, t.depth) for i, (t, w) in enumerate(zip(self.trees, self.weights))]
        kinds = "i int, weight double, feature array<int>, threshold array<double>, left array<int>, value array<double>, gains array<double>, depth int"
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Any:
        rows = sorted(spark.read.parquet(f"{path}/trees").collect())
        return cls([Tree(*[list(r[c]) for c in ("feature", "threshold", "left", "value", "gains")], r["depth"]) for r in rows], [r["weight"] for r in rows])


@dataclass
class GradientBoostingModel(Boosted):
    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, FlatTrees.of(self.trees).sums(vector_to_array(FEATURES), self.weights))

    def importances(self) -> list[float]:
        total = np.sum([t.gains for t in self.trees], axis=0)
        return (total / total.sum() if total.sum() > 0 else total).tolist()


# --- AdaBoost.R2 ----------------------------------------------------------------------------


@dataclass
class AdaBoostR2:
    """Drucker's AdaBoost.R2 (1997) with linear loss over weighted trees."""

    label: str
    rounds: int = 50
    learning_rate: float = 1.0
    max_depth: int = 3
    seed: int = 42
    checkpoint_every: int = 5

    def fit(self, df: DataFrame) -> AdaBoostR2Model:
        rows, count, features = learnt(df, self.label, True)
        cells = cells_of(rows, features)
        rounds = Rounds(blocks_of(rows, cells, 1.0, count), self.checkpoint_every)
        parts = rounds.blocks.rdd.getNumPartitions()
        trees, weights = [], []
        for i in range(self.rounds):
            held, targets, squares = cell_sums(rounds.blocks, cells)
            binned = Binned.of(cells, held, min(BINS, count))
            rounds.drop()
            root = root_sums(binned, held, targets, squares)  # so the first level needs no scan of its own
            grown = grow(rounds.blocks, np.uint16, binned, True, features, self.max_depth, 1, lambda y, state: y, lambda state: state, parts, ANY, root)
            shape, depth = grown.shape().by_cells(binned), grown.depth

            def missed(codes: np.ndarray, y: np.ndarray, shape=shape, depth=depth) -> np.ndarray:
                return np.abs(shape.value[shape.nodes(codes, depth)] - y)

            # the loss is the weighted mean error over the largest error: one scan gives all three
            largest, lost, weight = errors(rounds.blocks, missed)
            loss = lost / weight / largest if largest > 0 else 0.0
            if loss >= 0.5 and trees:
                break
            trees.append(grown.tree(binned))
            if loss <= 0 or loss >= 0.5:
                weights.append(1.0)
                break
            beta = loss / (1 - loss)
            weights.append(self.learning_rate * math.log(1 / beta))
            # dividing by the mean weight keeps weights near 1 over hundreds of rounds
            mean, rate = weight / count, self.learning_rate

            def reweighted(codes: np.ndarray, y: np.ndarray, state: np.ndarray, missed=missed, beta=beta, largest=largest, mean=mean) -> np.ndarray:
                return state / mean * beta ** ((1 - missed(codes, y) / largest) * rate)

            rounds.move(renewed(rounds.blocks, np.uint16, reweighted))
        rounds.close()
        return AdaBoostR2Model(trees, weights)


def errors(blocks: DataFrame, missed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[float, float, float]:
    """The largest error, the weighted sum of errors and the sum of weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for codes, y, w in arrays_of(batches, np.uint16):
            e = missed(codes, y)
            found.append((e.max(initial=0.0), w @ e, w.sum()))
        if found:
            largest, lost, weight = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (TaskContext.get().partitionId(), max(largest), sum(lost), sum(weight))], names=["part", "largest", "lost", "weight"])

    rows = sorted(blocks.mapInArrow(run, "part long, largest double, lost double, weight double").collect())
    return max(r["largest"] for r in rows), sum(r["lost"] for r in rows), sum(r["weight"] for r in rows)


@dataclass
class AdaBoostR2Model(Boosted):
    def transform(self, df: DataFrame) -> DataFrame:
        """Weighted median of the trees' predictions, from one expression over all trees at once."""
        return df.withColumn(PREDICTION, FlatTrees.of(self.trees).medians(vector_to_array(FEATURES), self.weights))

    def importances(self) -> list[float]:
        total = sum(self.weights)
        shares = [np.array(t.gains) / sum(t.gains) if sum(t.gains) > 0 else np.array(t.gains) for t in self.trees]
        return (sum(w * s for w, s in zip(self.weights, shares)) / total).tolist()
