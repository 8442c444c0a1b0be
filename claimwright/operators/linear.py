"""Penalised linear models from additive sums.

One scan gathers, per group of rows, the number of rows, the means of features and label, and their
products about those means. Such moments add up, so every fold, penalty and growing share of the
rows is fitted and scored from the same few matrices, without another look at the data: ridge by
its normal equations, lasso and elastic net by coordinate descent over the products, warm-started
along a path of falling penalties.

Tasks add blocks of rows with BLAS; their moments are merged in buckets before a bounded number of
them reaches the driver. Merging works on products about means, so large offsets cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as fx

FEATURES, PREDICTION = "features", "prediction"
MOST_FEATURES = 2048  # beyond, a matrix of products is no longer small
BUCKETS = 32
KINDS = ("lasso", "ridge", "elasticnet")
TOLERANCE = 1e-12  # of a coordinate's step, in units of the label's deviation


@dataclass
class Moments:
    """Rows, means and products about the means of features and, last, the label."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, block: np.ndarray) -> Moments:
        mean = block.mean(axis=0) if len(block) else np.zeros(block.shape[1])
        centred = block - mean
        return cls(float(len(block)), mean, centred.T @ centred)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return other if not self.n else self
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    @property
    def total(self) -> float:
        """Squared deviations of the label."""
        return float(self.products[-1, -1])


def merged(parts: Iterable[Moments], size: int = 0) -> Moments:
    return reduce(Moments.__add__, parts, Moments(0.0, np.zeros(size), np.zeros((size, size))))


PART = T.StructType(
    [T.StructField("group", T.ArrayType(T.LongType())), T.StructField("bucket", T.LongType()), T.StructField("n", T.DoubleType()), T.StructField("mean", T.BinaryType()), T.StructField("products", T.BinaryType())]
)


def _row(group: tuple, bucket: int, m: Moments) -> tuple:
    return list(group), bucket, m.n, m.mean.tobytes(), m.products.tobytes()


def _read(n: float, mean: bytes, products: bytes) -> Moments:
    means = np.frombuffer(mean)
    return Moments(n, means, np.frombuffer(products).reshape(len(means), len(means)))


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.list_(pa.int64()), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=PART.fieldNames())


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple, Moments] = {}
    bucket = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch["bucket"][0].as_py()
        flat = np.asarray(batch["x"].flatten(), np.float64)
        rows = np.column_stack([flat.reshape(batch.num_rows, -1), batch["y"].to_numpy()])
        groups = np.asarray(batch["group"].flatten()).reshape(batch.num_rows, -1)
        kinds, of = np.unique(groups, axis=0, return_inverse=True)
        for i, kind in enumerate(kinds):
            own = Moments.of(rows[of.ravel() == i])
            key = tuple(kind.tolist())
            found[key] = found[key] + own if key in found else own
    yield from _table([_row(g, bucket, m) for g, m in found.items()]).to_batches()


def _bucketed(key, table):
    columns = [table[n].to_pylist() for n in ("n", "mean", "products")]
    total = reduce(Moments.__add__, [_read(*r) for r in zip(*columns)])
    return _table([_row(key[0].as_py(), key[1].as_py(), total)])


def moments(df: DataFrame, label: str, groups: Sequence[Column] = ()) -> dict[tuple[int, ...], Moments]:
    """Moments per combination of integer group columns, from a vector column, in one scan.

    Rows without label are left out.
    """
    group = F.array(*[g.cast("long") for g in groups]) if groups else F.array(F.lit(0).cast("long"))
    y = fx.quoted(label).cast("double")
    rows = df.select(vector_to_array(FEATURES).alias("x"), y.alias("y"), group.alias("group"), (F.spark_partition_id() % BUCKETS).cast("long").alias("bucket"))
    parts = rows.where("y is not null and not isnan(y)").mapInArrow(_partial, PART).groupBy("group", "bucket").applyInArrow(_bucketed, PART)
    found: dict[tuple[int, ...], Moments] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["group"], r["bucket"])):
        key, own = tuple(r["group"]), _read(r["n"], bytes(r["mean"]), bytes(r["products"]))
        found[key] = found[key] + own if key in found else own
    return found


def penalties(kind: str, params: Mapping[str, Any], n: float) -> tuple[float, float]:
    """(l1, l2) on the mean squared error halved; ridge states its penalty on the sum."""
    alpha = params["alpha"]
    if kind == "lasso":
        return alpha, 0.0
    if kind == "ridge":
        return 0.0, alpha / n
    return alpha * params["l1_ratio"], alpha * (1 - params["l1_ratio"])


def descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, scale: float, start: np.ndarray, sweeps: int) -> np.ndarray:
    """Coordinate descent on w'Gw/2 - t'w + l1 |w| + l2 w'w/2. Constant features stay at 0."""
    w, reached = start.copy(), gram @ start
    diagonal = np.diag(gram)
    for _ in range(sweeps):
        largest = 0.0
        for j in np.flatnonzero(diagonal > 0):
            rho = target[j] - reached[j] + diagonal[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diagonal[j] + l2)
            step = new - w[j]
            if step:
                reached += gram[:, j] * step
                w[j] = new
                largest = max(largest, abs(step) * np.sqrt(diagonal[j]))
        if largest <= TOLERANCE * scale:
            break
    return w


def solve(kind: str, params: Mapping[str, Any], m: Moments, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(weights, intercept) of the penalised fit to the rows behind the moments."""
    gram, target = m.products[:-1, :-1] / m.n, m.products[:-1, -1] / m.n
    l1, l2 = penalties(kind, params, m.n)
    if l1 == 0:
        system = gram + l2 * np.eye(len(gram))
        # scaled to a unit diagonal, so that columns of very different size keep their digits
        size = np.sqrt(np.where(np.diag(system) > 0, np.diag(system), 1))
        w = np.linalg.lstsq(system / np.outer(size, size), target / size, rcond=1e-13)[0] / size
    else:
        w = descend(gram, target, l1, l2, np.sqrt(m.total / m.n), np.zeros(len(gram)) if start is None else start, params.get("max_iter", 1000) * 10)
    return w, float(m.mean[-1] - w @ m.mean[:-1])


def solve_path(kind: str, points: Sequence[Mapping[str, Any]], m: Moments) -> list[tuple[np.ndarray, float]]:
    """The fits of all points; each starts from that of the next larger penalty."""
    found: dict[int, tuple[np.ndarray, float]] = {}
    start = None
    for i in sorted(range(len(points)), key=lambda i: -penalties(kind, points[i], m.n)[0]):
        found[i] = solve(kind, points[i], m, start)
        start = found[i][0]
    return [found[i] for i in range(len(points))]


def r2(fit: tuple[np.ndarray, float], m: Moments) -> float | None:
    """Share explained on the rows behind the moments; None without rows.

    A constant label gives 1 for a perfect fit, else 0.
    """
    if not m.n:
        return None
    w, intercept = fit
    weights = np.append(-w, 1.0)
    off = m.mean[-1] - intercept - w @ m.mean[:-1]
    left = float(weights @ m.products @ weights) + m.n * off * off
    if m.total <= 0:
        return 1.0 if left <= 0 else 0.0
    return float(1 - left / m.total)


def fold_scores(kind: str, by_fold: Mapping[int, Moments], folds: int, points: Sequence[Mapping[str, Any]]) -> list[list[float | None]]:
    """r2 per point and fold, each fitted on all other folds; None where either side has no row."""
    size = next((len(m.mean) for m in by_fold.values()), 0)
    scores: list[list[float | None]] = [[] for _ in points]
    for fold in range(folds):
        train = merged((m for f, m in sorted(by_fold.items()) if f != fold), size)
        test = by_fold.get(fold, merged((), size))
        fits = solve_path(kind, points, train) if train.n and test.n else [None] * len(points)
        for own, fit in zip(scores, fits):
            own.append(None if fit is None else r2(fit, test))
    return scores


# --- as an estimator ------------------------------------------------------------------------


@dataclass
class LinearFit:
    """Weights and intercept, applied to a vector column as one expression."""

    coefficients: DenseVector
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, self.predicted(vector_to_array(FEATURES)))

    def predicted(self, x: Column) -> Column:
        """The prediction from an array of values."""
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        terms = F.zip_with(x, weights, lambda x, w: x * w)
        return F.aggregate(terms, F.lit(float(self.intercept)), lambda total, term: total + term)

    def save(self, spark: SparkSession, path: str) -> None:
        line = [(self.coefficients.toArray().tolist(), float(self.intercept))]
        spark.createDataFrame(line, "coefficients array<double>, intercept double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearFit:
        row = spark.read.parquet(path).first()
        return cls(Vectors.dense(row["coefficients"]), row["intercept"])


@dataclass
class LinearEstimator:
    """Fits a vector column in one scan."""

    kind: str
    params: Mapping[str, Any]
    label: str

    def fit(self, df: DataFrame) -> LinearFit:
        found = moments(df, self.label)
        if not found:
            raise ValueError("no row with a label")
        weights, intercept = solve(self.kind, self.params, merged(found.values()))
        return LinearFit(Vectors.dense(weights), intercept)
