"""Pairwise products of many columns, with missing values, from one scan per block of columns.

For every pair of columns four sums over the rows where both are present are enough for their
correlation: the rows, either column, either square, and the product. As matrices they are products
of the centred values, their squares and the 0/1 mask of what is present, so a task adds them with
BLAS, and matrices of tasks are merged in buckets before a bounded number reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 512  # columns on either side of a matrix
BUCKETS = 32
NOTHING = 1e-13  # of the squares: a variance below it is rounding


@dataclass
class PairSums:
    """Sums by pair: rows, column i, square of column i, product; over rows that have both."""

    sums: np.ndarray  # 6 x rows x columns: n, a, b, aa, bb, ab

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PairSums:
        """Of blocks of rows; missing values are NaN."""
        ma, mb = (~np.isnan(v) for v in (a, b))
        za, zb = np.where(ma, a, 0.0), np.where(mb, b, 0.0)
        ma, mb = ma.astype(np.float64), mb.astype(np.float64)
        return cls(np.stack([ma.T @ mb, za.T @ mb, ma.T @ zb, (za * za).T @ mb, ma.T @ (zb * zb), za.T @ zb]))

    def __add__(self, other: PairSums) -> PairSums:
        return PairSums(self.sums + other.sums)

    def correlations(self) -> np.ndarray:
        """NaN where either side is constant or no row has both."""
        n, a, b, aa, bb, ab = self.sums
        with np.errstate(invalid="ignore", divide="ignore"):
            va, vb = aa - a * a / n, bb - b * b / n
            r = (ab - a * b / n) / (np.sqrt(va) * np.sqrt(vb))
            return np.where((va > NOTHING * aa) & (vb > NOTHING * bb), r, np.nan)


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(1, batch.num_columns)])


def _summed(left: int, square: bool):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket = None, 0
        for batch in batches:
            if batch.num_rows:
                bucket, values = batch.column(0)[0].as_py(), _numbers(batch)
                own = PairSums.of(values[:, :left], values if square else values[:, left:])
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([total.sums.tobytes()], pa.binary())], names=["bucket", "sums"])

    return add


def _merged(key, table):
    total = reduce(np.add, (np.frombuffer(s) for s in table["sums"].to_pylist()))
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["bucket", "sums"])


def pair_sums(df: DataFrame, left: Mapping[str, Column], right: Mapping[str, Column] | None = None) -> PairSums:
    """Sums of all pairs of ``left`` columns with ``right`` ones, or among themselves."""
    columns = [*left.values(), *(right or {}).values()]
    numbered = df.select((F.spark_partition_id() % BUCKETS).cast("long").alias("bucket"), *[F.coalesce(c.cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = numbered.mapInArrow(_summed(len(left), right is None), "bucket long, sums binary").groupBy("bucket").applyInArrow(_merged, "bucket long, sums binary")
    shape = (6, len(left), len(right if right is not None else left))
    return reduce(PairSums.__add__, [PairSums(np.frombuffer(bytes(r["sums"])).reshape(shape)) for r in sorted(parts.collect())], PairSums(np.zeros(shape)))


def correlations(df: DataFrame, columns: Mapping[str, Column]) -> list[tuple[str, str, float | None]]:
    """(x, y, r) of every pair, x before y in the order given; r is null if undefined.

    ``columns`` are numeric expressions, best about their means.
    """
    names: Sequence[str] = list(columns)
    blocks = [dict(list(columns.items())[i : i + BLOCK]) for i in range(0, len(names), BLOCK)]
    found = []
    for i, left in enumerate(blocks):
        for j in range(i, len(blocks)):
            r = pair_sums(df, left, None if i == j else blocks[j]).correlations()
            for a, x in enumerate(left):
                for b, y in enumerate(blocks[j]):
                    if i < j or a < b:
                        found.append((i * BLOCK + a, j * BLOCK + b, x, y, None if np.isnan(r[a, b]) else float(r[a, b])))
    return [f[2:] for f in sorted(found, key=lambda f: f[:2])]
