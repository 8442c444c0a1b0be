"""Regression forests of any depth, grown in two phases.

A node with more rows than a task should hold is split by Spark: one scan sums the rows of all such
nodes by feature and bin, the sums give each node's best split, and its children go on. A node whose
rows fit is handed over whole: the rows are routed to it, grouped, and the subtree below it is
finished inside that task, with exact splits between neighbouring values. So the number of scans
follows the logarithm of the rows, not the depth of the trees, and the nodes never meet on the
driver: they are rows of a table, one per subtree. Only the few split nodes above the subtrees pass
through the driver. A large node that no feature can split, or that is as deep as allowed, is a leaf
whose mean comes from one more scan, so its rows go nowhere.

Trees whose root already fits share one copy of the rows per ``TREES`` of them. Rows travel as
compressed blocks of columns, and so do the nodes of a subtree, which hold one number each: the
threshold of a split or the value of a leaf. Bootstrap weights are
Poisson(1) numbers drawn from a hash of row and tree, so a recomputed task draws the same. Every
node looks at ``max_features`` features in a seeded order, and at further ones only while none of
them can be split. Pure nodes, nodes below ``min_samples_split`` rows and nodes at ``max_depth``
are leaves; without a depth trees grow until their leaves are pure or cannot be told apart.

Scoring sends each row once to every ``SCORED_TREES`` trees; a task holds a bounded block of rows and
streams the subtrees of its trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import columns as fx
from ..session import scratch_path

SUBTREE_BYTES = 160 << 20  # of rows that one task finishes a subtree on
SUBTREE_ROWS = 3_000_000  # at most, however few features there are
NEAR_ROWS = 1 << 18  # whose nodes are split together, where there are more
TREES = 5  # whole trees that share a copy of the rows
PASS_BYTES = 128 << 20  # of sums that a task of a splitting scan holds
SCORED_BYTES = 160 << 20  # of rows that a scoring task holds
SCORED_TREES = 12  # trees that share a copy of the scored rows
BLOCK_BYTES = 8 << 20  # of rows that travel together
MOST_PARTITIONS = 10_000
QUANTILES = 256  # bins over all rows of a feature
WIDTHS = 64  # bins of equal width within a node's own range
NOISE = 1e-9  # gains that differ by less, as a share, are equal: the first one counts
FEATURES = "features"


# --- seeded numbers -----------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; overflow wraps."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hashed(values: np.ndarray, *salt: int) -> np.ndarray:
    out = np.asarray(values).astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            out = mixed(out + np.uint64(0x9E3779B97F4A7C15) * np.uint64((s + 1) & 0xFFFFFFFF))
    return out


POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def weights_of(rows: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row counts in a tree."""
    if not bootstrap:
        return np.ones(len(rows))
    share = (hashed(rows, seed, tree) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.searchsorted(POISSON, share, side="right").astype(np.float64)


def feature_orders(nodes: np.ndarray, tree: int, seed: int, features: int) -> np.ndarray:
    """The order in which each node looks at the features. ``nodes`` are numbers of paths."""
    keys = np.stack([hashed(nodes, seed + 1, tree, f) for f in range(features)], axis=1)
    return np.argsort(keys, axis=1, kind="stable")


def path_of(parent, right):
    """The number of a child's path; paths are told apart by 64-bit hashes."""
    return hashed(np.asarray(parent), 77) + np.asarray(right).astype(np.uint64)


# --- growing in memory --------------------------------------------------------------------


@dataclass
class Subtree:
    """Arrays of one subtree's nodes. A leaf has feature -1; the right child follows the left one."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gains: np.ndarray  # summed decrease of the squared error by feature

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[descend(x, self.feature, self.threshold, self.left)]

    def sealed(self) -> bytes:
        """One number per node; the places of the children follow from the order of the nodes."""
        number = np.where(self.feature >= 0, self.threshold, self.value)
        return sealed([self.feature.astype(np.int16 if self.feature.max(initial=0) < 1 << 15 else np.int32), number])

    @classmethod
    def of(cls, block: bytes) -> Subtree:
        feature, number = unsealed(block)
        inner = feature >= 0
        return cls(feature, number, np.where(inner, np.cumsum(inner) * 2 - 1, 0), number, np.zeros(0))


def sealed(columns: list[np.ndarray]) -> bytes:
    """Columns of one length as a compressed block."""
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[str(i) for i in range(len(columns))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unsealed(block: bytes, columns: list[int] | None = None) -> list[np.ndarray]:
    """All columns of a block, or the named ones."""
    with pa.ipc.open_stream(block, options=pa.ipc.IpcReadOptions(included_fields=columns)) as stream:
        return [c.to_numpy() for c in stream.read_next_batch().columns]


def descend(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        at = node[rows]
        inner = feature[at] >= 0
        rows, at = rows[inner], at[inner]
        node[rows] = left[at] + (x[rows, feature[at]] > threshold[at])
    return node


@dataclass(frozen=True)
class Growth:
    """Settings of the trees."""

    max_features: int
    max_depth: int | None = None
    min_samples_split: int = 2
    seed: int = 42
    bootstrap: bool = True


class Ranked:
    """Columns as ranks among their distinct values, so that every sort is one of integers."""

    def __init__(self, x: np.ndarray) -> None:
        self.rank(x.T, x.shape[1], len(x))

    @classmethod
    def of(cls, columns: Iterator[np.ndarray], features: int, rows: int) -> Ranked:
        """From columns that come one at a time."""
        ranked = cls.__new__(cls)
        ranked.rank(columns, features, rows)
        return ranked

    def rank(self, columns: Iterable[np.ndarray], features: int, rows: int) -> None:
        self.values, self.codes = [], np.empty((features, rows), np.int32)
        for f, column in enumerate(columns):
            values, self.codes[f] = np.unique(column, return_inverse=True)
            self.values.append(values)
        self.span = max((len(v) for v in self.values), default=1)


def grow(ranked: Ranked, y: np.ndarray, w: np.ndarray, growth: Growth, tree: int, path: int = 0, depth: int = 0) -> Subtree:
    """One subtree, level by level; all nodes of a level are split by the same few sorts.

    Rows lie in the order of their nodes. Once a level has more than ``NEAR_ROWS`` of them, its nodes go
    on in groups of about so many, so that the arrays of nearly all levels are short.
    """
    rows = np.flatnonzero(w > 0)
    features = len(ranked.codes)
    if not len(rows):
        return Subtree(np.full(1, -1), np.zeros(1), np.zeros(1, np.int64), np.zeros(1), np.zeros(features))
    values, offsets = np.concatenate([*ranked.values, np.zeros(0)]), np.cumsum([0, *[len(v) for v in ranked.values]])
    bits = int(ranked.span).bit_length()
    made, gains, known = [], np.zeros(features), 1  # nodes by the first of their numbers, which are dealt by level and group
    todo = [(0, np.array([path], np.uint64), depth, ranked.codes[:, rows], y[rows], w[rows], np.array([len(rows)]))]
    while todo:
        first, paths, level, codes, y, w, size = todo.pop()
        start = np.cumsum(size) - size
        weight = np.add.reduceat(w, start)
        value = np.add.reduceat(w * y, start) / weight
        feature, threshold, left = np.full(len(size), -1), np.zeros(len(size)), np.zeros(len(size), np.int64)
        made.append((first, feature, threshold, left, value))
        wanted = (size >= growth.min_samples_split) & (np.minimum.reduceat(y, start) < np.maximum.reduceat(y, start))
        if growth.max_depth is not None and level >= growth.max_depth:
            continue
        if not wanted.all():
            keep = np.flatnonzero(np.repeat(wanted, size))
            codes, y, w = codes.take(keep, axis=1), y[keep], w[keep]
        asked = np.flatnonzero(wanted)
        if not len(asked):
            continue
        cuts = best_cuts(codes, y, w, size[asked], weight[asked], value[asked], feature_orders(paths[asked], tree, growth.seed, features), growth.max_features, bits)
        split = cuts.feature >= 0
        if not split.any():
            continue
        size = size[asked]
        if not split.all():
            keep = np.flatnonzero(np.repeat(split, size))
            codes, y, w, size = codes.take(keep, axis=1), y[keep], w[keep], size[split]
        asked, f, below, above, gain = asked[split], *(c[split] for c in (cuts.feature, cuts.below, cuts.above, cuts.gain))
        gains += np.bincount(f, gain, features)
        a, b = values[offsets[f] + below], values[offsets[f] + above]
        middle = a + (b - a) / 2
        feature[asked], threshold[asked] = f, np.where((middle < b) & np.isfinite(middle), middle, a)
        left[asked] = known + 2 * np.arange(len(asked))
        # rows go on in the order of the children
        at = np.arange(len(y))
        right = codes.ravel()[np.repeat(f * len(y), size) + at] > np.repeat(below, size)
        child = np.repeat(2 * np.arange(len(size)), size) + right
        size = np.bincount(child, minlength=2 * len(size))
        shift = len(at).bit_length()
        order = np.sort(child << shift | at) & ((1 << shift) - 1)
        codes, y, w = codes.take(order, axis=1), y[order], w[order]
        paths = np.stack([path_of(paths[asked], np.full(len(asked), side)) for side in (0, 1)], axis=1).ravel()
        for a, b in groups_of(size):
            own = slice(size[:a].sum(), size[:b].sum())
            todo.append((known + a, paths[a:b], level + 1, np.ascontiguousarray(codes[:, own]), y[own], w[own], size[a:b]))
        known += len(size)
        del codes, y, w
    feature, threshold, left, value = np.empty(known, np.int64), np.empty(known), np.empty(known, np.int64), np.empty(known)
    for first, *columns in made:
        for whole, part in zip((feature, threshold, left, value), columns):
            whole[first : first + len(part)] = part
    order, at = [], np.zeros(1, np.int64)  # level by level, whatever the groups
    while len(at):
        order.append(at)
        at = left[at[feature[at] >= 0]]
        at = np.stack([at, at + 1], axis=1).ravel()
    order = np.concatenate(order)
    feature, threshold, value, inner = feature[order], threshold[order], value[order], feature[order] >= 0
    return Subtree(feature, threshold, np.where(inner, np.cumsum(inner) * 2 - 1, 0), value, gains)


def groups_of(size: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring nodes with about ``NEAR_ROWS`` rows together; a larger node is alone."""
    large, window = size > NEAR_ROWS, (np.cumsum(size) - size) // NEAR_ROWS
    new = np.flatnonzero((window[1:] != window[:-1]) | large[1:] | large[:-1]) + 1
    return list(zip([0, *new.tolist()], [*new.tolist(), len(size)]))


@dataclass
class Cuts:
    """The best cut of every node, with the codes on both sides of it. Feature -1: none."""

    feature: np.ndarray
    below: np.ndarray
    above: np.ndarray
    gain: np.ndarray


def best_cuts(
    codes: np.ndarray, y: np.ndarray, w: np.ndarray, size: np.ndarray, weight: np.ndarray, value: np.ndarray, orders: np.ndarray, looked_at: int, bits: int
) -> Cuts:
    """Looks at ``looked_at`` features of every node in its order, and at further ones while none can be cut.

    ``codes`` have at most ``bits`` bits. A sort key holds node, code and row, so it needs no second array.
    """
    features, count = codes.shape[0], len(size)
    cuts = Cuts(np.full(count, -1), np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, -np.inf))
    node = np.repeat(np.arange(count), size)
    off = w * (y - np.repeat(value, size))  # about the node's mean, which keeps sums small
    flat = codes.ravel()
    for turn in range(features):
        if turn < looked_at:
            some, its, sizes, asked = np.arange(len(y)), node, size, np.arange(count)
        else:
            asked = np.flatnonzero(cuts.feature < 0)
            if not len(asked):
                break
            some = np.flatnonzero((cuts.feature < 0)[node])
            its, sizes = np.repeat(np.arange(len(asked)), size[asked]), size[asked]
        shift = len(y).bit_length()
        key = its << bits
        key |= flat[np.repeat(orders[asked, turn] * len(y), sizes) + some]
        key <<= shift
        key |= some
        key.sort()
        row = key & ((1 << shift) - 1)
        key >>= shift
        ends = np.cumsum(sizes)
        differs = key[1:] != key[:-1]
        differs[ends[:-1] - 1] = False  # between nodes
        ok = np.flatnonzero(differs)
        if not len(ok):
            continue
        owner = its[ok]
        sums = []
        for part in (w[row], off[row]):
            upto = np.cumsum(part)
            before = np.concatenate([np.zeros(1), upto[ends[:-1] - 1]])
            sums.append(upto[ok] - before[owner])
        (lw, lo) = sums
        all_w = weight[asked][owner]
        gain = lo * lo
        gain *= all_w
        gain /= lw * (all_w - lw)
        first = np.flatnonzero(np.concatenate([np.ones(1, bool), owner[1:] != owner[:-1]]))
        top = np.maximum.reduceat(gain, first)
        where = np.flatnonzero(gain >= np.repeat(top * (1 - NOISE), np.diff(np.append(first, len(owner)))))
        where = where[np.unique(owner[where], return_index=True)[1]]  # the first of equal cuts
        who = asked[owner[first]]
        better = (cuts.feature[who] < 0) | (top > cuts.gain[who] * (1 + NOISE))
        at, who = ok[where[better]], who[better]
        cuts.feature[who], cuts.gain[who] = orders[who, turn], top[better]
        cuts.below[who], cuts.above[who] = key[at] & ((1 << bits) - 1), key[at + 1] & ((1 << bits) - 1)
    return cuts


# --- the split nodes above the subtrees -----------------------------------------------------


@dataclass
class Top:
    """The upper part of one tree. Leaves without a value are handed over: they are roots of subtrees."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    path: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    value: list[float | None] = field(default_factory=lambda: [None])

    def __post_init__(self) -> None:
        self.value = [*self.value, *[None] * (len(self.feature) - len(self.value))]

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.threshold[node], self.left[node] = feature, threshold, at
        for right in (0, 1):
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(0)
            self.path.append(int(path_of(np.array([self.path[node]], np.uint64), np.array([right]))[0]))
            self.depth.append(self.depth[node] + 1)
            self.value.append(None)
        return at, at + 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left)


def units_of(tops: list[Top]) -> tuple[dict[tuple[int, int], int], int]:
    """Number of the task that finishes each (tree, node), and how many tasks have whole trees.

    Whole trees go ``TREES`` to a task and come first.
    """
    whole = [t for t, top in enumerate(tops) if len(top.feature) == 1 and top.value[0] is None]
    found = {(tree, 0): i // TREES for i, tree in enumerate(whole)}
    shared = at = math.ceil(len(whole) / TREES)
    for tree, top in enumerate(tops):
        if len(top.feature) > 1:
            for node, f in enumerate(top.feature):
                if f < 0 and top.value[node] is None:
                    found[tree, node] = at
                    at += 1
    return found, shared


def matrix(column: pa.Array, features: int) -> np.ndarray:
    """A block of rows from a column of lists."""
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), features)


def block_rows(features: int) -> int:
    return max(1, BLOCK_BYTES // (8 * (features + 2)))


def blocks_of(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[list[np.ndarray]]:
    """Row ids, values by feature and further columns of about ``BLOCK_BYTES`` at a time."""

    def joined(held: list[pa.RecordBatch]) -> list[np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        x = matrix(table["x"].combine_chunks(), features)
        return [table["row"].to_numpy(), x, *[table[n].to_numpy() for n in table.column_names if n not in ("row", "x")]]

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= block_rows(features):
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def _routed(tops: list[Top], features: int, growth: Growth):
    """Blocks of rows (ids, values by feature, label) for each unit that needs them."""
    units, shared = units_of(tops)
    numbers: dict[int, dict[int, int]] = {}
    for (tree, node), unit in units.items():
        numbers.setdefault(tree, {})[node] = unit
    deep = [(tree, top.arrays(), np.array([numbers.get(tree, {}).get(n, -1) for n in range(len(top.feature))])) for tree, top in enumerate(tops) if len(top.feature) > 1]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(unit: int, data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([unit], pa.int32()), pa.array([data], pa.binary())], names=["unit", "block"])

        for ids, x, y in blocks_of(batches, features):
            if shared:
                data = sealed([ids, *x.T, y])
                for unit in range(shared):
                    yield block(unit, data)
            for tree, arrays, unit_of in deep:
                keep = np.flatnonzero(weights_of(ids, tree, growth.seed, growth.bootstrap) > 0)
                unit = unit_of[descend(x[keep], *arrays)]
                order = np.argsort(unit, kind="stable")
                keep, unit = keep[order], unit[order]
                ends = np.r_[np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit)]
                for a, b in zip(np.r_[0, ends[:-1]], ends):
                    if b > a and unit[a] >= 0:
                        own = keep[a:b]
                        yield block(int(unit[a]), sealed([ids[own], *x[own].T, y[own]]))

    return route


def spread(rows: DataFrame, column: str, count: int) -> DataFrame:
    """One value of an integer column per partition, where Spark can plan so many."""
    return rows.repartitionById(count, column) if count <= MOST_PARTITIONS else rows.repartition(MOST_PARTITIONS, column)


# --- splitting large nodes by scans -----------------------------------------------------------


@dataclass
class Open:
    """A node that is too large for a task, with the range that its rows are known to lie in."""

    tree: int
    node: int
    path: int
    depth: int
    low: np.ndarray
    high: np.ndarray
    edges: dict[int, np.ndarray] = field(default_factory=dict)  # of the features it looks at now

    def look(self, quantiles: list[np.ndarray], growth: Growth) -> bool:
        """Chooses features and bins; False if no feature can be split."""
        order = feature_orders(np.array([self.path], np.uint64), self.tree, growth.seed, len(self.low))[0]
        self.edges = {}
        for f in [f for f in order.tolist() if self.low[f] < self.high[f]][: growth.max_features]:
            low, high = self.low[f], self.high[f]
            inside = quantiles[f][(quantiles[f] >= low) & (quantiles[f] < high)]
            if len(inside) < WIDTHS // 4:
                steps = low + (high - low) * (np.arange(1, WIDTHS) / WIDTHS)
                inside = np.unique(np.r_[inside, low, steps[np.isfinite(steps) & (steps >= low) & (steps < high)]])
            self.edges[f] = inside
        return bool(self.edges)


CELL = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("open", "feature", "bin", "n")] + [T.StructField(n, T.DoubleType()) for n in ("w", "s", "low", "high")]
)


def _summed(tops: dict[int, tuple], asked: list[Open], features: int, centre: float, growth: Growth):
    """Sums of the rows of the open nodes by feature and bin, one row per cell and task."""
    by_tree: dict[int, dict[int, int]] = {}
    for i, o in enumerate(asked):
        by_tree.setdefault(o.tree, {})[o.node] = i
    slots = [(i, f, edges) for i, o in enumerate(asked) for f, edges in o.edges.items()]
    starts = np.cumsum([0, *[len(edges) + 1 for _, _, edges in slots]])
    slots_of: dict[int, list[int]] = {}
    for k, (i, _, _) in enumerate(slots):
        slots_of.setdefault(i, []).append(k)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, w, s = (np.zeros(starts[-1]) for _ in range(3))
        low, high = np.full(starts[-1], np.inf), np.full(starts[-1], -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, ids = matrix(batch["x"], features), batch["y"].to_numpy() - centre, batch["row"].to_numpy()
            for tree, numbers in by_tree.items():
                weight = weights_of(ids, tree, growth.seed, growth.bootstrap)
                rows = np.flatnonzero(weight > 0)
                leaf = descend(x[rows], *tops[tree])
                order = np.argsort(leaf, kind="stable")
                rows, leaf = rows[order], leaf[order]
                for node, i in numbers.items():
                    a, b = np.searchsorted(leaf, [node, node + 1])
                    own = rows[a:b]
                    for k in slots_of.get(i, ()):
                        _, f, edges = slots[k]
                        v = x[own, f]
                        cell = starts[k] + np.searchsorted(edges, v, side="left")
                        np.add.at(n, cell, 1)
                        np.add.at(w, cell, weight[own])
                        np.add.at(s, cell, weight[own] * y[own])
                        np.minimum.at(low, cell, v)
                        np.maximum.at(high, cell, v)
        full = np.flatnonzero(n)
        slot = np.searchsorted(starts, full, side="right") - 1
        owner, feature = (np.array([slots[k][j] for k in slot.tolist()], np.int64) for j in (0, 1))
        columns = [owner, feature, full - starts[slot], n[full].astype(np.int64), w[full], s[full], low[full], high[full]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=CELL.fieldNames())

    return scan


def best_splits(cells: DataFrame) -> DataFrame:
    """Per open node and feature: rows, range, and the best cut with its gain; null without any cut."""
    merged = cells.groupBy("open", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "w", "s")], F.min("low").alias("low"), F.max("high").alias("high"))
    node = Window.partitionBy("open", "feature")
    upto = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    left = {f"l{c}": F.sum(c).over(upto) for c in ("n", "w", "s")}
    whole = {f"a{c}": F.sum(c).over(node) for c in ("n", "w", "s")}
    cuts = merged.withColumns({**left, **whole, "next": F.lead("low").over(node.orderBy("bin"))})
    gain = F.col("ls") ** 2 / F.col("lw") + (F.col("as") - F.col("ls")) ** 2 / (F.col("aw") - F.col("lw")) - F.col("as") ** 2 / F.col("aw")
    cut = F.when(F.col("next").isNotNull(), F.struct(gain.alias("gain"), -F.col("bin"), F.col("high").alias("below"), F.col("next").alias("above"), F.col("ln").alias("n_left")))
    return cuts.groupBy("open", "feature").agg(F.max("an").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max(cut).alias("cut"))


def grow_tops(table: DataFrame, features: int, rows: int, bound: int, trees: int, growth: Growth) -> tuple[list[Top], np.ndarray]:
    """The upper parts of all trees, and their gains by tree and feature."""
    tops, gains = [Top() for _ in range(trees)], np.zeros((trees, features))
    if rows <= bound or not features:
        return tops, gains
    closed = []  # large nodes that stay leaves
    ends = [F.struct(F.min(F.get("x", f)).alias("low"), F.max(F.get("x", f)).alias("high")).alias(f"e{f}") for f in range(features)]
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    sketches = [F.percentile_approx(F.get("x", f), shares, 10_000).alias(f"q{f}") for f in range(features)]
    first = table.agg(F.avg("y").alias("y"), *ends, *sketches).first()
    quantiles = [np.unique(first[f"q{f}"]) for f in range(features)]
    box = [np.array([first[f"e{f}"][k] for f in range(features)], np.float64) for k in ("low", "high")]
    todo = [Open(t, 0, 0, 0, *[b.copy() for b in box]) for t in range(trees)]
    each = max(1, PASS_BYTES // (growth.max_features * QUANTILES * 40))

    def cells(asked: list[Open]) -> DataFrame:
        arrays = {t: tops[t].arrays() for t in {o.tree for o in asked}}
        return table.mapInArrow(_summed(arrays, asked, features, first["y"], growth), CELL)

    while todo:
        asked, todo = todo[:each], todo[each:]
        looking = [(growth.max_depth is None or o.depth < growth.max_depth) and o.look(quantiles, growth) for o in asked]
        closed += [o for o, looks in zip(asked, looking) if not looks]
        asked = [o for o, looks in zip(asked, looking) if looks]
        if not asked:
            continue
        found = best_splits(cells(asked)).collect()
        by_node: dict[int, list] = {}
        for r in found:
            by_node.setdefault(r["open"], []).append(r)
        for i, o in enumerate(asked):
            for r in by_node.get(i, []):
                o.low[r["feature"]], o.high[r["feature"]] = r["low"], r["high"]
            cuts = [(r["cut"]["gain"], r["feature"], r) for r in by_node.get(i, []) if r["cut"] is not None]
            if not cuts:  # all looked at are constant or within one bin; the range is now known exactly
                if by_node.get(i) and by_node[i][0]["n"] > bound:
                    todo.append(o)
                continue
            gain, f, r = max(cuts, key=lambda c: (c[0], -c[1]))
            if r["n"] <= bound:  # fewer than was thought: it fits a task as it is
                continue
            below, above = r["cut"]["below"], r["cut"]["above"]
            middle = below + (above - below) / 2
            middle = middle if middle < above and math.isfinite(middle) else below
            gains[o.tree, f] += max(0.0, gain)
            children = tops[o.tree].split(o.node, f, middle)
            for child, n in zip(children, (r["cut"]["n_left"], r["n"] - r["cut"]["n_left"])):
                if n > bound:
                    low, high = o.low.copy(), o.high.copy()
                    if child == children[0]:
                        high[f] = below
                    else:
                        low[f] = above
                    todo.append(Open(o.tree, child, tops[o.tree].path[child], o.depth + 1, low, high))
    while closed:
        asked, closed = closed[:each], closed[each:]
        for o in asked:
            o.edges = {0: np.zeros(0)}  # one cell
        for r in cells(asked).groupBy("open").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.sum("s").alias("s")).collect():
            o = asked[r["open"]]
            if r["n"] > bound:  # else fewer than was thought: a task looks at it again
                tops[o.tree].value[o.node] = first["y"] + r["s"] / r["w"]
    return tops, gains


# --- the estimator ------------------------------------------------------------------------


SUBTREES = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("unit", "tree", "node", "nodes")]
    + [T.StructField("block", T.BinaryType())]
    + [T.StructField("gains", T.ArrayType(T.DoubleType()))]
)


def _finished(tops: list[Top], features: int, growth: Growth):
    roots: dict[int, list[tuple[int, int]]] = {}
    for key, unit in units_of(tops)[0].items():
        roots.setdefault(unit, []).append(key)

    def finish(key, table):
        unit = key[0].as_py()
        blocks = table["block"].to_pylist()

        def column(i: int) -> np.ndarray:
            return np.concatenate([unsealed(b, [i])[0] for b in blocks])

        rows = column(0)
        order = np.argsort(rows, kind="stable")  # sums then do not depend on the order of arrival
        rows, y = rows[order], column(1 + features)[order]
        ranked = Ranked.of((column(1 + f)[order] for f in range(features)), features, len(order))
        del blocks, table, order
        out = []
        for tree, node in roots[unit]:
            top = tops[tree]
            grown = grow(ranked, y, weights_of(rows, tree, growth.seed, growth.bootstrap), growth, tree, top.path[node], top.depth[node])
            out.append((unit, tree, node, len(grown.feature), grown.sealed(), grown.gains.tolist()))
        return pa.table([pa.array([o[i] for o in out], kind) for i, kind in enumerate([pa.int32()] * 4 + [pa.binary(), pa.list_(pa.float64())])], names=SUBTREES.fieldNames())

    return finish


def _dealt(features: int, groups: int, blocks: int):
    """Blocks of rows (ids, values by feature) for each group of trees."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks_of(batches, features):
            dealt = hashed(ids, 99) % np.uint64(blocks)
            for block in range(blocks):
                own = np.flatnonzero(dealt == block)
                data = sealed([ids[own], *x[own].T])
                for group in range(groups) if len(own) else ():
                    yield pa.RecordBatch.from_arrays([pa.array([group * blocks + block], pa.int32()), pa.array([data], pa.binary())], names=["slot", "block"])

    return deal


def _predicted(tops: list[Top], features: int, blocks: int):
    """Holds the rows of a slot and streams its subtrees through them; the rows come first."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, step = None, [], block_rows(features)
        ids, x, total, tree, leaf = np.zeros(0, np.int64), np.zeros((0, features)), np.zeros(0), None, None

        def ready() -> None:
            """All rows of the slot are there: adds what the upper parts already know."""
            nonlocal ids, x, total, held
            ids = np.concatenate([h[0] for h in held]) if held else np.zeros(0, np.int64)
            x, at = np.empty((len(ids), features)), 0
            for h in held:
                x[at : at + len(h[0])] = np.stack(h[1:], axis=1) if features else 0
                at += len(h[0])
            total, held = np.zeros(len(ids)), []
            group = slot // blocks
            for top in tops[group * SCORED_TREES : (group + 1) * SCORED_TREES]:
                if any(v is not None for v in top.value):
                    known = np.array([v or 0.0 for v in top.value])
                    for a in range(0, len(ids), step):
                        total[a : a + step] += known[descend(x[a : a + step], *top.arrays())]

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                ready()
            for a in range(0, len(ids), step):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + step]), pa.array(total[a : a + step])], names=["row", "total"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch["slot"][i].as_py() != slot:
                    yield from done()
                    slot, ids, tree = batch["slot"][i].as_py(), ids[:0], None
                data = batch["block"][i].as_py()
                if not batch["tree"][i].is_valid:
                    held.append(unsealed(data))
                    continue
                if held:
                    ready()
                subtree, node = Subtree.of(data), batch["node"][i].as_py()
                if batch["tree"][i].as_py() != tree:
                    tree, leaf = batch["tree"][i].as_py(), None
                    if len(tops[tree].feature) > 1:
                        leaf = np.concatenate([descend(x[a : a + step], *tops[tree].arrays()).astype(np.int32) for a in range(0, len(ids), step)] or [np.zeros(0, np.int32)])
                own = np.arange(len(ids)) if leaf is None else np.flatnonzero(leaf == node)
                for a in range(0, len(own), step):
                    some = own[a : a + step]
                    total[some] += subtree.predict(x[some])
        yield from done()

    return predict


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("__x", vector_to_array(FEATURES))


def _kept(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class RandomForest:
    """A forest of ``trees`` trees; ``max_features`` is a number, "sqrt", "log2" or None for all."""

    label: str
    trees: int = 100
    max_depth: int | None = None
    max_features: int | str | None = None
    min_samples_split: int = 2
    seed: int = 42
    bootstrap: bool = True

    def looked_at(self, features: int) -> int:
        named = {"sqrt": math.isqrt(features), "log2": int(math.log2(features)) if features else 1, None: features}
        return max(1, min(features, named.get(self.max_features, self.max_features)))

    def fit(self, df: DataFrame) -> RandomForestModel:
        """Fits on a vector column; rows without label are left out."""
        spark = df.sparkSession
        rows = _vectors(df).select(F.col("__x").alias("x"), fx.quoted(self.label).cast("double").alias("y")).where("y is not null and not isnan(y)")
        table = _kept(spark, rows.withColumn("row", F.monotonically_increasing_id()), "forest")
        seen = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("features")).first()
        if not seen["n"]:
            raise ValueError("no row with a label")
        features = seen["features"]
        growth = Growth(self.looked_at(features), self.max_depth, self.min_samples_split, self.seed, self.bootstrap)
        bound = max(1, min(SUBTREE_ROWS, SUBTREE_BYTES // (8 * (features + 2))))
        tops, gains = grow_tops(table, features, seen["n"], bound, self.trees, growth)
        routed = table.select("row", "x", "y").mapInArrow(_routed(tops, features, growth), "unit int, block binary")
        parts = spread(routed, "unit", 1 + max(units_of(tops)[0].values(), default=0))
        grown = parts.groupBy("unit").applyInArrow(_finished(tops, features, growth), SUBTREES)
        subtrees = _kept(spark, grown, "subtrees")
        below = subtrees.select("tree", F.posexplode("gains").alias("f", "gain")).groupBy("tree", "f").agg(F.sum("gain").alias("gain")).collect()
        for r in below:
            gains[r["tree"], r["f"]] += r["gain"]
        shares = gains / np.where(gains.sum(axis=1) > 0, gains.sum(axis=1), 1)[:, None]
        importances = shares.mean(axis=0)
        total = importances.sum()
        return RandomForestModel(subtrees, tops, features, self.trees, (importances / total if total > 0 else importances).tolist())


@dataclass
class RandomForestModel:
    """Subtrees as a table, one row each, under the few split nodes of ``tops``."""

    subtrees: DataFrame
    tops: list[Top]
    features: int
    trees: int
    importances: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, the mean over the trees. The rows are written once, so that ids hold."""
        spark = df.sparkSession
        rows = _kept(spark, _vectors(df).withColumn("__row", F.monotonically_increasing_id()), "scored")
        asked = rows.select(F.col("__row").alias("row"), F.col("__x").alias("x"))
        blocks = max(1, math.ceil(asked.count() * 8 * max(1, self.features) / SCORED_BYTES))
        groups = math.ceil(self.trees / SCORED_TREES)
        place = [F.lit(None).cast("int").alias(n) for n in ("tree", "node")]
        visits = asked.mapInArrow(_dealt(self.features, groups, blocks), "slot int, block binary").select("slot", *place, "block")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("n")
        models = self.subtrees.select("tree", "node", "block", every).select((F.floor(F.col("tree") / SCORED_TREES) * blocks + F.col("n")).cast("int").alias("slot"), "tree", "node", "block")
        both = spread(models.unionByName(visits), "slot", groups * blocks).sortWithinPartitions("slot", F.asc_nulls_first("tree"), "node")
        totals = both.mapInArrow(_predicted(self.tops, self.features, blocks), "row long, total double").groupBy(F.col("row").alias("__of")).agg((F.sum("total") / self.trees).alias("prediction"))
        kept = [c for c in df.columns if c != "prediction"]
        return rows.join(totals, F.col("__row") == F.col("__of")).select(*[fx.quoted(c) for c in kept], "prediction")

    def save(self, spark: SparkSession, path: str) -> None:
        """The subtrees and the nodes above them as tables."""
        self.subtrees.write.mode("overwrite").parquet(f"{path}/subtrees")
        lines = [(json.dumps({"features": self.features, "importances": self.importances, "trees": self.trees}), -1)]
        lines += [(json.dumps(vars(top)), i) for i, top in enumerate(self.tops)]
        spark.createDataFrame(lines, "value string, tree int").write.mode("overwrite").parquet(f"{path}/tops")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RandomForestModel:
        lines = {r["tree"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/tops").collect()}
        head = lines.pop(-1)
        return cls(spark.read.parquet(f"{path}/subtrees"), [Top(**lines[i]) for i in sorted(lines)], head["features"], head["trees"], head["importances"])
