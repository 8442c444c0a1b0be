"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. A fixed random rotation spreads that
distance over blocks of coordinates; in at least one block it does not exceed the block's share
of the budget, in proportion to its width. So each block is joined by range on its own: its
first two coordinates form a grid whose cells are twice the block's radius wide, every vector
lives in one cell and visits the following cells that its radius reaches. The union of what the
blocks find is verified on the whole vectors in double precision, and a pair counts only in the
first block that finds it, so nothing is counted twice and no pairs leave a task: a task returns
per vector the number of its links and a tie to the connected group it found.

Equal vectors are one class and are compared once. Cells are cut into parts of bounded size and
parts are compared with parts, so no task holds a whole dense cell.

Vectors that are null, empty or zero, or hold null or non-finite components link with nothing
and are kept; so is a row with a null id, with no component. Vectors of different length never
link. Repeated rows count as further vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .components import components, written

BLOCKS = 4
PART = 16384  # vectors of a cell held at once by a task, for either side
TILE = 1024
SLACK = 1e-9


class Subspaces:
    """Rotation, blocks and budgets for vectors of one length."""

    def __init__(self, size: int, least_cosine: float) -> None:
        rng = np.random.default_rng(7919 + size)
        self.rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
        self.blocks = np.array_split(np.arange(size), max(1, min(BLOCKS, size // 2)))
        budget = 2 - 2 * least_cosine + SLACK
        self.budgets = [budget * len(block) / size for block in self.blocks]

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors in rotated coordinates; row by row the same whatever the batch."""
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
        return np.einsum("ij,jk->ik", unit, self.rotation)

    def cells(self, rotated: np.ndarray, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(rows, cells, home): each row's own cell, then the following ones it reaches."""
        radius = np.sqrt(self.budgets[block]) * (1 + 1e-6)
        places = rotated[:, self.blocks[block][:2]] / (2 * radius)
        if places.shape[1] == 1:
            places = np.hstack([places, np.zeros_like(places)])
        own = np.floor(places).astype(np.int64)
        above, below = places - own >= 0.5, places - own < 0.5
        everything = np.arange(len(rotated))
        yield everything, own, True
        for step in ((0, 1), (1, -1), (1, 0), (1, 1)):
            reaches = np.ones(len(rotated), bool)
            for axis, d in enumerate(step):
                reaches &= above[:, axis] if d == 1 else below[:, axis] if d == -1 else True
            yield everything[reaches], own[reaches] + np.array(step), False


def _placed(least_cosine: float):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Subspaces] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                values = part.column(2)
                sizes = np.diff(np.asarray(values.offsets))
                flat = np.asarray(values.flatten())
                starts = np.concatenate([[0], np.cumsum(sizes)])
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    vectors = flat[starts[rows][:, None] + np.arange(size)]
                    space = spaces.setdefault(int(size), Subspaces(int(size), least_cosine))
                    rotated = space.rotated(vectors)
                    raw = [v.tobytes() for v in np.ascontiguousarray(vectors)]
                    for block in range(len(space.blocks)):
                        for who, cells, home in space.cells(rotated, block):
                            if len(who):
                                taken = part.take(pa.array(rows[who]))
                                yield pa.RecordBatch.from_arrays(
                                    [
                                        pa.array([int(size)] * len(who), pa.int32()),
                                        pa.array([block] * len(who), pa.int32()),
                                        pa.array(cells[:, 0]),
                                        pa.array(cells[:, 1]),
                                        pa.array([home] * len(who)),
                                        taken.column(0),
                                        taken.column(1),
                                        pa.array([raw[i] for i in who], pa.binary()),
                                    ],
                                    names=["size", "block", "x", "y", "home", "id", "copies", "vector"],
                                )

    return place


def _linked(least_cosine: float, schema: T.StructType):
    def links(key, table):
        size, block, low, high = (key[0].as_py(), key[1].as_py(), key[4].as_py(), key[5].as_py())
        space = Subspaces(size, least_cosine)
        vectors = np.frombuffer(b"".join(table["vector"].to_pylist()), np.float64).reshape(-1, size)
        rotated = space.rotated(vectors)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        ids, copies, part = table["id"], table["copies"].to_numpy(), table["part"].to_numpy()
        own, budget = rotated[:, space.blocks[block]].copy(), space.budgets[block]
        squares = (own * own).sum(axis=1)
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        added, group = np.zeros(len(ids), np.int64), np.arange(len(ids))
        edges = [b[0] for b in space.blocks]
        for i in range(0, len(left), TILE):
            a = left[i : i + TILE]
            for j in range(i if low == high else 0, len(right), TILE):
                b = right[j : j + TILE]
                near = squares[a][:, None] + squares[b] - 2 * own[a] @ own[b].T <= budget + SLACK
                if low == high and i == j:
                    near = np.triu(near, 1)
                p, q = np.nonzero(near)
                for k in range(0, len(p), 65536):
                    u, v = a[p[k : k + 65536]], b[q[k : k + 65536]]
                    cosine = np.einsum("ij,ij->i", vectors[u], vectors[v]) / (norms[u] * norms[v])
                    u, v = u[cosine >= least_cosine], v[cosine >= least_cosine]
                    shares = np.add.reduceat(np.square(rotated[u] - rotated[v]), edges, axis=1)
                    first = (shares <= np.array(space.budgets) + SLACK).argmax(axis=1) == block
                    u, v = u[first], v[first]
                    np.add.at(added, u, copies[v])
                    np.add.at(added, v, copies[u])
                    while len(u):
                        least = np.minimum(group[u], group[v])
                        np.minimum.at(group, group[u], least)
                        np.minimum.at(group, group[v], least)
                        group = group[group]
                        apart = group[u] != group[v]
                        u, v = u[apart], v[apart]
        while (group != group[group]).any():
            group = group[group]
        who = pa.array(np.flatnonzero(added))
        return pa.table([ids.take(who), pa.array(added[added > 0]), ids.take(pa.array(group[added > 0]))], names=schema.fieldNames())

    return links


def link_vectors(classes: DataFrame, least_cosine: float) -> DataFrame:
    """(id, links, other) per vector and task: links found there, and a vector of its connected group."""
    kind = classes.schema["first"].dataType
    fields = [("size", T.IntegerType()), ("block", T.IntegerType()), ("x", T.LongType()), ("y", T.LongType()), ("home", T.BooleanType()), ("id", kind), ("copies", T.LongType()), ("vector", T.BinaryType())]
    placed = classes.select("first", "copies", "v").mapInArrow(_placed(least_cosine), T.StructType([T.StructField(n, t) for n, t in fields]))
    cell = ["size", "block", "x", "y"]
    # parts of the homes are numbered from 0, those of the visitors follow
    held = (
        placed.groupBy(*cell)
        .agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors"))
        .where("homes > 0 and homes + visitors > 1")
        .select(*cell, F.ceil(F.col("homes") / PART).cast("int").alias("inner"), F.ceil(F.col("visitors") / PART).cast("int").alias("outer"))
    )
    spread = F.pmod(F.xxhash64("id", *cell), F.when(F.col("home"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    parts = (
        placed.join(held, cell)
        .withColumn("part", F.when(F.col("home"), spread).otherwise(F.col("inner") + spread))
        .withColumn("meets", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("inner") + F.col("outer")).otherwise(F.col("inner")) - 1)))
        .select(*cell, F.least("part", "meets").alias("low"), F.greatest("part", "meets").alias("high"), "id", "copies", "vector", "part")
    )
    schema = T.StructType([T.StructField("id", kind), T.StructField("links", T.LongType()), T.StructField("other", kind)])
    return parts.groupBy(*cell, "low", "high").applyInArrow(_linked(least_cosine, schema), schema)


def near_vectors(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least_cosine: float = 0.95) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept."""
    values = F.col("v")
    finite = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("id").isNotNull() & values.isNotNull() & F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")).withColumn("v", F.when(sound, values))
    classes = written(spark, rows.where("v is not null").groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")), "vectors")
    links = written(spark, link_vectors(classes, least_cosine), "links")
    found = components(spark, links.select(F.col("id").alias("a"), F.col("other").alias("b"))).toDF("node", "component")
    totals = links.groupBy(F.col("id").alias("linked")).agg(F.sum("links").alias("links"))
    named = (
        classes.join(totals, F.col("first") == F.col("linked"), "left")
        .join(found, F.col("first") == F.col("node"), "left")
        .select(F.col("v").alias("of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component"))
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(named, F.col("v") == F.col("of"), "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
