"""Hard negatives through anchor-clustered shared lists.

Anchors are clustered by direction. For one cluster and one block of candidates, every candidate
has an upper bound on its inner product with any unit anchor of the cluster: its norm times the
cosine of its angle to the cluster's centre less the cluster's widest angle. The block's candidates
are sorted by that bound once; all members of the cluster walk the one list, a stretch at a time,
and each stops as soon as the next bound, times its own norm, is below what it still needs. That
certifies that nothing further down can enter its result, so results are exact.

Blocks are parts of at most about ``BLOCK`` rows of the candidates around one centre, so that a
whole block has a bound as well, from the triangle inequality between centres. The search runs in
three rounds over the same table of blocks. Positives are sought in the blocks around the anchors'
own centres first; what is then the last of each anchor's positives decides which other blocks it
has to visit at all. Negatives need only blocks whose bound reaches the smallest score that any of
the anchor's positives allows.

Centres are fitted on at most ``SAMPLE`` anchors, those of least hash; every anchor and every row is
assigned, and the number of centres follows the square root of the number of anchors. Tasks hold
one block and at most about ``GROUP`` anchors. Blocks that no anchor must visit are not sent.

Components are floor(``SCALE`` * x), kept in 64 bits; scores are exact integers, through doubles where
those hold them and Python's integers elsewhere, and are clipped to 64 bits where they are formed.

Rows with null id, label or vector, or with a null or non-finite component, take no part. Vectors
of different lengths never meet; empty and zero vectors score 0 with all others. Rows that repeat
an id, label and vector are one row; rows that only share the id are rows of their own, but an
anchor has no positive of its own id. Other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .components import written

SCALE = 256
SAMPLE = 4096
MAX_CENTRES = 256
BLOCK = 16384
GROUP = 8192
STRETCH = 1024  # candidates of a list that are scored at once
MEMBERS = 2048  # anchors that walk together
SLACK = 1e-6  # on angles, far more than arccos loses
EXACT = 2.0**53
LONG = 2**63


def vectors_of(column: pa.Array, size: int) -> np.ndarray:
    """Rows of 64-bit components from a column of their bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), size)


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors.astype(np.float64)).sum(axis=1))


def angles(vectors: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of every vector to every unit centre; 0 for zero vectors, whose scores are all 0."""
    cosines = vectors.astype(np.float64) @ centres.T / np.where(norms > 0, norms, 1)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0.0)


def fit_centres(vectors: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Unit centres of a spherical k-means, started from evenly spaced vectors."""
    unit = vectors / norms_of(vectors)[:, None]
    centres = unit[np.linspace(0, len(unit) - 1, count).astype(int)]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        lengths = np.sqrt(np.square(sums).sum(axis=1))
        centres = np.where(lengths[:, None] > 1e-9, sums / np.where(lengths > 1e-9, lengths, 1)[:, None], centres)
    return centres


class Centres:
    """Fitted centres by vector length; lengths without any have one, the diagonal."""

    def __init__(self, fitted: dict[int, np.ndarray]) -> None:
        self.fitted = fitted

    def of(self, size: int) -> np.ndarray:
        found = self.fitted.get(size)
        return np.full((1, size), 1 / np.sqrt(max(1, size))) if found is None else found

    def gaps(self) -> list[tuple[int, int, int, float]]:
        """(size, cluster, cell, angle) of every pair of centres."""
        return [
            (size, i, j, float(a))
            for size, centres in self.fitted.items()
            for i, row in enumerate(np.arccos(np.clip(centres @ centres.T, -1, 1)))
            for j, a in enumerate(row)
        ]


def _assigned(centres: Centres, names: list[str]):
    """Adds centre, angle to it, and norm."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                sizes = part["size"].to_numpy()
                centre, angle, norm = np.zeros(len(sizes), np.int32), np.zeros(len(sizes)), np.zeros(len(sizes))
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    vectors = vectors_of(part["v"].take(pa.array(rows)), int(size))
                    norm[rows] = norms_of(vectors)
                    apart = angles(vectors, norm[rows], centres.of(int(size)))
                    centre[rows], angle[rows] = apart.argmin(axis=1), apart.min(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(centre), pa.array(angle), pa.array(norm)], names=[*names, "centre", "angle", "norm"])

    return assign


def assigned(rows: DataFrame, centres: Centres) -> DataFrame:
    added = [T.StructField("centre", T.IntegerType()), T.StructField("angle", T.DoubleType()), T.StructField("norm", T.DoubleType())]
    return rows.mapInArrow(_assigned(centres, rows.columns), T.StructType([*rows.schema.fields, *added]))


# --- walking a list -----------------------------------------------------------------------


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products, doubles while they hold them, else Python's integers; clipped to 64 bits."""
    largest = float(np.abs(left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0))
    if largest * left.shape[1] < EXACT:
        return left.astype(np.float64) @ right.astype(np.float64).T
    return np.minimum(np.maximum(left.astype(object) @ right.astype(object).T, -LONG), LONG - 1)


class Best:
    """The best ``k`` (score, id) of one anchor and need: higher scores first, then smaller ids."""

    def __init__(self, k: int, floor, ceiling) -> None:
        self.k, self.floor, self.ceiling, self.found = k, floor, ceiling, []

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = np.ones(len(scores), bool)
        if self.ceiling is not None:
            fits &= scores <= self.ceiling
        least = self.least()
        if least is not None:
            fits &= scores >= least
        where = np.flatnonzero(fits)
        if len(where):
            if len(where) > 4 * self.k:  # the best k of the offer, smaller ids first
                where = where[np.lexsort((ids[where], -scores[where]))[: self.k]] if scores.dtype != object else where
            both = self.found + [(-s, i) for s, i in zip(scores[where].tolist(), ids[where].tolist())]
            self.found = sorted(both)[: self.k]

    def least(self):
        """What a further candidate must reach; None if anything would do."""
        return -self.found[-1][0] if len(self.found) == self.k else self.floor


def walk(members: np.ndarray, norms: np.ndarray, labels: np.ndarray, needs: list[list[Best]], same: bool, block: dict, bounds: np.ndarray, own_ids: np.ndarray) -> None:
    """All members walk the block in descending order of ``bounds``; each stops once certified."""
    order = np.argsort(-bounds, kind="stable")
    sorted_bounds, walking = bounds[order], np.arange(len(members))
    for at in range(0, len(order), STRETCH):
        # the most that a member can still get from here on, with room for rounding
        reach = norms[walking] * sorted_bounds[at]
        reach = reach + np.abs(reach) * 1e-9 + 1e-6
        open_ = [any(b.least() is None or b.least() <= r for b in needs[m]) for m, r in zip(walking, reach)]
        walking = walking[np.array(open_, bool)]
        if not len(walking):
            return
        part = order[at : at + STRETCH]
        vectors, their_labels, ids = block["v"][part], block["label"][part], block["id"][part]
        for low in range(0, len(walking), MEMBERS):
            some = walking[low : low + MEMBERS]
            scores = _scores(members[some], vectors)
            alike = labels[some][:, None] == their_labels
            useful = alike & (own_ids[some][:, None] != ids) if same else ~alike
            for row, m in enumerate(some):
                least = [b.least() for b in needs[m]]
                if None not in least:
                    useful[row] &= (scores[row] >= min(least)).astype(bool)
            for row in np.flatnonzero(useful.any(axis=1)):
                wanted = useful[row]
                for need in needs[some[row]]:
                    need.offer(scores[row][wanted], ids[wanted])


def _walked(centres: Centres, same: bool, k: int, low: int, high: int, schema: T.StructType):
    def search(key, table):
        size = key[0].as_py()
        candidate = table["anchor"].to_numpy(zero_copy_only=False) < 0
        rows, anchors = table.filter(pa.array(candidate)), table.filter(pa.array(~candidate))
        block = {"v": vectors_of(rows["v"], size), "id": rows["id"].to_numpy(), "label": rows["label"].to_numpy()}
        block_norms = norms_of(block["v"])
        vectors, norms, radii = vectors_of(anchors["v"], size), anchors["norm"].to_numpy(), anchors["radius"].to_numpy()
        cluster, labels, ids = anchors["centre"].to_numpy(), anchors["label"].to_numpy(), anchors["id"].to_numpy()
        scores, names = anchors["needs"].to_pylist(), anchors["anchor"].to_pylist()
        out: list[tuple[int, int | None, int, int]] = []
        for c in np.unique(cluster):
            mine = np.flatnonzero(cluster == c)
            to_centre = angles(block["v"], block_norms, centres.of(size)[c : c + 1])[:, 0]
            cosine = np.cos(np.clip(to_centre - radii[mine[0]] - SLACK, 0, np.pi))
            bounds = block_norms * cosine
            if same:
                needs = [[Best(k, min(scores[m], default=None), None)] for m in mine]
            else:
                needs = [[Best(k, -(-low * s // high), s) for s in scores[m]] for m in mine]
            walk(vectors[mine], norms[mine], labels[mine], needs, same, block, bounds, ids[mine])
            for m, bests in zip(mine, needs):
                for best, wanted in zip(bests, [None] if same else scores[m]):
                    out += [(names[m], wanted, i, int(-s)) for s, i in best.found]
        return pa.table([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=schema.fieldNames())

    return search


def blocks_to_visit(anchors: DataFrame, blocks: DataFrame, gaps: DataFrame, near: bool | None) -> DataFrame:
    """Every anchor with each block (b_size, b_centre, b_block) that it must visit.

    ``near``: only blocks of the anchors' own centre, only others, or all. Anchors have ``floor``, the
    least score that is of use to them, null if any is.
    """
    of = blocks.toDF(*[f"b_{c}" for c in blocks.columns])
    # every block as seen from every cluster, so that the join goes by cluster and not by length alone
    seen = of.join(gaps, (F.col("b_size") == F.col("g_size")) & (F.col("b_centre") == F.col("g_cell")), "left")
    seen = seen.withColumns({"seen_from": F.coalesce("g_cluster", F.lit(0)), "gap": F.coalesce("gap", F.lit(0.0))})
    if near is not None:
        own = F.col("seen_from") == F.col("b_centre")
        seen = seen.where(own if near else ~own)
    pairs = anchors.join(seen, (F.col("size") == F.col("b_size")) & (F.col("centre") == F.col("seen_from")))
    least = F.greatest(F.col("gap") - F.col("b_angle") - F.col("radius") - 3 * SLACK, F.lit(0.0))
    cosine = F.cos(F.least(least, F.lit(float(np.pi))))
    reach = F.col("norm") * cosine * F.when(cosine >= 0, F.col("b_most")).otherwise(F.col("b_least"))
    return pairs.where(F.col("floor").isNull() | (reach + F.abs(reach) * 1e-9 + 1e-6 >= F.col("floor")))


def searched(table: DataFrame, pairs: DataFrame, centres: Centres, same: bool, k: int, low: int = 0, high: int = 1) -> DataFrame:
    """(anchor, needed, id, score): the best of every block for its visitors."""
    cell = ["size", "centre", "block"]
    visits = pairs.select("anchor", "id", "label", "v", "norm", "radius", "needs", "centre", *[F.col(f"b_{c}").alias(f"to_{c}") for c in cell])
    groups = visits.groupBy(*[f"to_{c}" for c in cell]).agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    counted = groups.toDF(*[f"c_{c}" for c in cell], "groups")

    def here(prefix: str) -> Column:
        return (F.col(f"{prefix}size") == F.col("c_size")) & (F.col(f"{prefix}centre") == F.col("c_centre")) & (F.col(f"{prefix}block") == F.col("c_block"))

    where = ["c_size", "c_centre", "c_block", "part"]
    nothing = {"norm": F.lit(None).cast("double"), "radius": F.lit(None).cast("double"), "needs": F.lit(None).cast("array<bigint>")}
    # a block goes to every group of its visitors, a visitor to one
    homes = table.join(counted, here("")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    homes = homes.select(*where, F.lit(-1).cast("long").alias("anchor"), "id", "label", "v", *[v.alias(n) for n, v in nothing.items()], F.col("c_centre").alias("centre"))
    guests = visits.join(counted, here("to_")).withColumn("part", F.pmod(F.xxhash64("anchor"), F.col("groups")).cast("int"))
    guests = guests.select(*where, "anchor", "id", "label", "v", "norm", "radius", "needs", "centre")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "needed", "id", "score")])
    return homes.unionByName(guests).groupBy(*where).applyInArrow(_walked(centres, same, k, low, high, schema), schema)


def best(found: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """The best k per key, ranked from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sound_rows(vectors: DataFrame, vec_id: str, embedding: str, label: str, relabelled: Callable[[Column, Column], Column]) -> DataFrame:
    """id, label, size and components as bytes of all rows that take part, each once."""
    v = F.col("e")
    sound = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("given"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    rows = rows.where(F.col("id").isNotNull() & F.col("given").isNotNull() & sound)
    whole = F.transform("e", lambda x: F.floor(x * SCALE))
    kept = rows.select("id", relabelled(F.col("id"), F.col("given")).alias("label"), F.size("e").alias("size"), whole.alias("c")).groupBy("id", "label", "size", "c").agg(F.lit(1).alias("one"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            components = batch.column(3)
            flat, ends = np.asarray(components.flatten()), np.asarray(components.offsets)
            ends = ends - ends[0]
            raw = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw, pa.binary())], names=["id", "label", "size", "v"])

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("v", T.BinaryType())])
    return kept.select("id", "label", "size", "c").mapInArrow(packed, schema)


def contract_label(vec_id: Column, label: Column) -> Column:
    """Where the id is divisible by 7 the label moves on by one, modulo 10."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def mine_negatives(
    spark: SparkSession,
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    relabelled: Callable[[Column, Column], Column] = contract_label,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are rows whose id is divisible by ``every``; a negative's score is between ``low`` and
    ``high`` parts of ``high`` of its positive's.
    """
    rows = written(spark, sound_rows(vectors, vec_id, embedding, label, relabelled), "vectors")
    marked = written(spark, rows.where(F.col("id") % every == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    # centres from the anchors of least hash; zero vectors have no direction
    sample = marked.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("size", "v").toArrow()
    fitted, sizes = {}, np.asarray(sample["size"])
    total = marked.count()
    for size in np.unique(sizes):
        own = vectors_of(sample["v"].filter(pa.array(sizes == size)), int(size))
        own = own[norms_of(own) > 0].astype(np.float64)
        share = total * (sizes == size).sum() / len(sizes)
        if len(own):
            fitted[int(size)] = fit_centres(own, min(MAX_CENTRES, len(own), int(np.ceil(np.sqrt(share)))))
    centres = Centres(fitted)
    gaps = spark.createDataFrame(centres.gaps(), "g_size int, g_cluster int, g_cell int, gap double")

    table = written(spark, assigned(rows, centres), "assigned")
    cells = table.groupBy("size", "centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).toDF("s", "c", "blocks")
    table = table.join(cells, (F.col("size") == F.col("s")) & (F.col("centre") == F.col("c"))).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")).drop("s", "c", "blocks")
    table = written(spark, table, "blocks")
    blocks = written(spark, table.groupBy("size", "centre", "block").agg(F.max("angle").alias("angle"), F.max("norm").alias("most"), F.min("norm").alias("least")), "bounds")

    placed = assigned(marked, centres)
    radii = placed.groupBy("size", "centre").agg(F.max("angle").alias("radius")).toDF("s", "c", "radius")
    placed = written(spark, placed.join(radii, (F.col("size") == F.col("s")) & (F.col("centre") == F.col("c"))).drop("s", "c", "angle"), "anchors")

    # positives: own centre first, then the other blocks that may hold better ones
    unknown = placed.withColumns({"needs": F.array().cast("array<bigint>"), "floor": F.lit(None).cast("double")})
    home = written(spark, best(searched(table, blocks_to_visit(unknown, blocks, gaps, True), centres, True, positives), positives, ["anchor"]).drop("rank"), "positives")
    reached = home.groupBy(F.col("anchor").alias("of")).agg(F.when(F.count(F.lit(1)) >= positives, F.min("score")).alias("least"))
    known = placed.join(reached, F.col("anchor") == F.col("of"), "left").withColumns({"needs": F.when(F.col("least").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("least")), "floor": F.col("least").cast("double")})
    away = searched(table, blocks_to_visit(known, blocks, gaps, False), centres, True, positives)
    chosen = written(spark, best(home.unionByName(away), positives, ["anchor"]).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # negatives: below a positive score that is not negative, nothing else fits the window
    wanted = chosen.where("positive_score >= 0").groupBy(F.col("anchor").alias("of")).agg(F.sort_array(F.collect_set("positive_score")).alias("needs"))
    seeking = placed.join(wanted, F.col("anchor") == F.col("of")).withColumn("floor", F.get("needs", 0) * F.lit(low / high))
    found = searched(table, blocks_to_visit(seeking, blocks, gaps, None), centres, False, negatives, low, high)
    ranked = best(found, negatives, ["anchor", "needed"]).toDF("of", "needed", "negative_id", "negative_score", "rank")
    names = placed.select(F.col("anchor").alias("named"), F.col("id").alias("anchor_id"))
    joined = chosen.join(ranked, (F.col("anchor") == F.col("of")) & (F.col("positive_score") == F.col("needed"))).join(names, F.col("anchor") == F.col("named"))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
