"""Importances of regression forests of bounded depth over binned rows.

Trees follow MLlib's rules (``boost``): at most 32 bins per feature, the split with the largest
decrease of the variance, bootstrap weights from a Poisson distribution, here drawn from a hash of row
and tree. All trees share the bins, so for a tree all rows with the same bins are one: the sum of their
weights and of their weighted labels is all it needs. One scan gives these sums for all trees, and each
tree grows from its own in one task. Where too few rows agree, the rows are scanned once per tree and
level instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .boost import BINS, KEYED, Binned, Grower, Merger, arrays_of, bins_of, blocks_of, cell_weights, cells_of, grow, keys_of, learnt, node_sums, unweighted
from .forest import weights_of

TABLE_BYTES = 96 << 20  # of all trees' sums that a task holds
AGREEING = 8  # rows to a combination of bins, at least, for sums by combination


@dataclass
class BaggedTrees:
    """A forest that looks at all features in every node; only its importances are kept."""

    label: str
    trees: int = 100
    max_depth: int = 10
    seed: int = 42

    def importances(self, df: DataFrame) -> list[float]:
        """Every tree's shares of the decrease of the squared error, averaged."""
        rows, count, features = learnt(df, self.label, False)
        cells = cells_of(rows, features)
        blocks = blocks_of(rows, cells, None, count)
        binned = Binned.of(cells, cell_weights(blocks, cells, unweighted), min(BINS, count))
        if features <= KEYED and combinations(blocks, binned) * AGREEING <= count:
            sums = blocks.mapInArrow(self._summed(binned), "tree int, keys binary, sums binary")
            grown = sums.groupBy("tree").applyInArrow(self._grown(features), "tree int, gains array<double>")
            gains = np.array([r["gains"] for r in sorted(grown.collect())])
        else:
            gains = np.array([self._scanned(blocks, binned, features, tree) for tree in range(self.trees)])
        blocks.unpersist()
        shares = gains / np.where(gains.sum(axis=1) > 0, gains.sum(axis=1), 1)[:, None]
        total = shares.sum(axis=0)
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def _weights(self, rows: np.ndarray, tree: int) -> np.ndarray:
        return weights_of(rows, tree, self.seed, True)

    def _scanned(self, blocks: DataFrame, binned: Binned, features: int, tree: int) -> np.ndarray:
        parts = blocks.rdd.getNumPartitions()
        return grow(blocks, np.uint16, binned, True, features, self.max_depth, 1, lambda y, _: y, lambda rows: self._weights(rows, tree), parts).gains

    def _summed(self, binned: Binned):
        trees = self.trees

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out(keys: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
                for tree in range(trees):
                    own = sums[2 * tree : 2 * tree + 2]
                    some = own[0] > 0
                    columns = pa.array([tree], pa.int32()), pa.array([keys[some].tobytes()]), pa.array([own[:, some].tobytes()])
                    yield pa.RecordBatch.from_arrays(list(columns), names=["tree", "keys", "sums"])

            held, most = Merger(), max(1, TABLE_BYTES // (16 * trees))
            for codes, y, rows in arrays_of(batches, np.uint16):
                keys, place = np.unique(keys_of(binned.codes(codes)), return_inverse=True)
                sums = np.empty((2 * trees, len(keys)))
                for tree in range(trees):
                    w = self._weights(rows, tree)
                    sums[2 * tree] = np.bincount(place, w, len(keys))
                    sums[2 * tree + 1] = np.bincount(place, w * y, len(keys))
                held.add(keys, sums)
                if held.full(most):
                    yield from out(*held.merge())
                    held = Merger()
            if held.size:
                yield from out(*held.merge())

        return run

    def _grown(self, features: int):
        def run(key, table):
            held = Merger()
            for keys, sums in sorted(zip(table["keys"].to_pylist(), table["sums"].to_pylist())):  # whatever the order of arrival
                held.add(np.frombuffer(keys, np.int64), np.frombuffer(sums, np.float64).reshape(2, -1))
            keys, (w, wy) = held.merge()
            grown, bins, mean = Grower(features, self.max_depth, 1), bins_of(keys, features), wy / w
            while len(w) and grown.open and grown.depth < self.max_depth:
                shape, asked = grown.shape(), grown.open
                place_of = np.full(len(shape.feature), -1)
                place_of[asked] = np.arange(len(asked))
                found = node_sums(bins, place_of[shape.nodes(bins, grown.depth)], len(asked), mean, w)
                further = grown.split(asked, found[: -len(asked)].reshape(3, len(asked), features, BINS), found[-len(asked) :])
                if len(grown.feature) == len(shape.feature):
                    break
                grown.open, grown.depth = further, grown.depth + 1
            return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "gains": pa.array([grown.gains.tolist()], pa.list_(pa.float64()))})

        return run


def combinations(blocks: DataFrame, binned: Binned) -> int:
    """How many combinations of bins the rows have, about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, _, _ in arrays_of(batches, np.uint16):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys_of(binned.codes(codes))))], names=["key"])

    return blocks.mapInArrow(run, "key long").agg(F.approx_count_distinct("key")).first()[0]
