"""A prefix trie of rebuilt conversations through composable monoid fingerprints.

A rebuilt conversation is a head of its base conversation followed by its own turns after as many.
No rebuilt text is ever made. A turn in place i stands for the monoid element (1, t * r^i), with t
a hash of role and text; elements compose as (n, s) * (m, u) = (n + m, s + u), in four residues of
31 bits each. So the fingerprint of every rebuilt prefix is a symbolic combination of sums that
exist once per stored conversation: the base's head, plus the own sum up to the turn without the
own head, moved by the power of r that lies between the two heads' lengths.

Prefixes with one fingerprint and depth are a node. Equality is verified through references to the
stored turns that end the prefixes: within every node all parents must have one fingerprint, and
all distinct references must show one role and one text. By induction over depth whole prefixes
are then equal. If two different prefixes ever share a fingerprint, all is done again with other
hashes.

Subtree sums need no walk from level to level. A node belongs to its smallest member; the nodes of
one member are a chain that ends with its conversation, so a node's sums are what its own chain
has from there on plus the totals of all other chains that pass through it, one row per passage.

Sizes: places in a conversation come from a range partitioned sort, running sums go through pieces
of ``PIECE`` turns, nodes and chains are summed before they are shuffled, and the ids that end in a
node are joined to pieces of text by ranges and hashed as a stream. So neither a very long
conversation nor a node of very many members is held by a task; the pieces of a node do pass one
task in order, since SHA-256 is not composable.

Turns of equal number are ordered by the md5 digests of role and text. Null role or text is empty;
rows without conversation id take no part; repeated rows are further turns. ``c - c % 100`` is taken as SQL does,
towards zero. An empty table has no node, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .columns import whole
from .components import written

PRIME = 2**31 - 1
RESIDUES = 4
DIGIT = 32  # powers of r are looked up by digits of the place in this base
PIECE = 1024
TEXT = 4096  # ids in one piece of text
NODE = ["depth", "k1", "k2"]


def bases(attempt: int) -> list[int]:
    rnd = random.Random(7919 + attempt)
    return [rnd.randrange(2**20, PRIME - 1) for _ in range(RESIDUES)]


def power(base: int, place: Column) -> Column:
    """base^place mod PRIME for places below 2^30, by a look-up per digit."""
    out = F.lit(1).cast("long")
    for k in range(6):
        row = [pow(base, d * DIGIT**k, PRIME) for d in range(DIGIT)]
        digit = F.pmod(F.floor(place / F.lit(DIGIT**k)), F.lit(DIGIT)).cast("int")
        out = out * F.get(F.array(*[F.lit(x).cast("long") for x in row]), digit) % PRIME
    return out


def placed_turns(spark: SparkSession, conversations: DataFrame, names: Sequence[str]) -> DataFrame:
    """conv_id, place from 0, role and text of every turn, in a written table."""
    conv, turn, role, text = [F.col(f"`{n}`") for n in names]
    turns = conversations.select(conv.alias("conv_id"), turn.alias("turn"), whole(role).alias("role"), whole(text).alias("text")).where("conv_id is not null")
    # digests keep the bounds of the ranges small; the last key spreads repeated rows, which may stand in any order
    keyed = turns.withColumns({"a": F.md5("role"), "b": F.md5("text"), "row": F.monotonically_increasing_id()})
    order = ["conv_id", F.asc_nulls_first("turn"), "a", "b", "row"]
    ranked = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranked = written(spark, ranked.select("conv_id", "at", "role", "text"), "turns").withColumn("file", F.shiftright("at", 33))
    parts = ranked.groupBy("conv_id", "file").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("conv_id").alias("conv"), F.col("file").alias("of"), (F.col("first") - before).alias("zero"))
    place = (F.col("at") - F.col("zero")).alias("place")
    return written(spark, ranked.join(starts, (F.col("conv_id") == F.col("conv")) & (F.col("file") == F.col("of"))).select("conv_id", place, "role", "text"), "placed")


def running(rows: DataFrame, key: str, place: str, sums: dict[str, str]) -> DataFrame:
    """Adds running sums, own row included, of columns along gapless places of a key.

    First within pieces, then over the totals of the pieces, so no task holds a long key.
    """
    pieces = rows.withColumn("__piece", F.floor(F.col(place) / PIECE))
    totals = pieces.groupBy(key, "__piece").agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    earlier = Window.partitionBy(key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(key).alias("__key"), F.col("__piece").alias("__of"), *[F.coalesce(F.sum(f"__t_{c}").over(earlier), F.lit(0)).alias(f"__c_{c}") for c in sums])
    within = Window.partitionBy(key, "__piece").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    local = pieces.withColumns({f"__s_{c}": F.sum(c).over(within) for c in sums})
    joined = local.join(carried, (F.col(key) == F.col("__key")) & (F.col("__piece") == F.col("__of")))
    return joined.select(*[F.col(c) for c in rows.columns], *[(F.col(f"__s_{c}") + F.col(f"__c_{c}")).alias(name) for c, name in sums.items()])


def fingerprinted(spark: SparkSession, turns: DataFrame, attempt: int) -> DataFrame:
    """conv_id, place, size and s0 to s3: sums of the elements up to and with the turn, mod PRIME."""
    elements = turns.select(
        "conv_id",
        "place",
        F.length("text").cast("long").alias("size"),
        *[(F.pmod(F.xxhash64(F.lit(i + RESIDUES * attempt), "role", "text"), F.lit(PRIME)) * power(r, F.col("place")) % PRIME).alias(f"e{i}") for i, r in enumerate(bases(attempt))],
    )
    summed = running(elements, "conv_id", "place", {f"e{i}": f"s{i}" for i in range(RESIDUES)})
    return written(spark, summed.select("conv_id", "place", "size", *[(F.col(f"s{i}") % PRIME).alias(f"s{i}") for i in range(RESIDUES)]), "sums")


def prefixes(spark: SparkSession, sums: DataFrame, span: int, heads: int, attempt: int) -> tuple[DataFrame, DataFrame]:
    """(passages, sizes): one row per rebuilt conversation and non-empty prefix; turns of each.

    A passage has its node key and that of its parent, the reference (ref_conv, ref_place) to the
    stored turn that ends it, and that turn's size.
    """
    state = F.struct("size", *[f"s{i}" for i in range(RESIDUES)])
    own = sums.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("place") < heads - 1, F.struct("place", state.alias("state"))))).alias("head")
    )
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    base = own.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    given = own.withColumn("wanted", F.col("conv_id") - F.col("conv_id") % span).join(base, F.col("wanted") == F.col("base"), "left")
    # the first h of the base's turns, all if fewer
    cut = F.slice(F.coalesce("base_head", F.array().cast(own.schema["head"].dataType)), 1, F.col("h").cast("int"))
    given = given.select("conv_id", "n", "head", "h", "base", cut.alias("base_head")).withColumn("b", F.size("base_head").cast("long"))
    given = written(spark, given, "heads")

    def sums_at(head: Column, count: Column) -> list[Column]:
        """The sums over the first ``count`` turns of a head."""
        return [F.coalesce(F.get(head, (count - 1).cast("int"))["state"][f"s{i}"], F.lit(0).cast("long")) for i in range(RESIDUES)]

    def keys(parts: list[Column], name: str) -> list[Column]:
        return [(F.shiftleft(parts[2 * j], 31) + parts[2 * j + 1]).alias(f"{name}{j + 1}") for j in range(2)]

    taken = given.select("conv_id", "base", F.posexplode("base_head").alias("i", "turn"), "base_head")
    from_base = taken.select(
        "conv_id",
        (F.col("i") + 1).cast("long").alias("depth"),
        *keys([F.col(f"turn.state.s{i}") for i in range(RESIDUES)], "k"),
        *keys(sums_at(F.col("base_head"), F.col("i")), "p"),
        F.col("base").alias("ref_conv"),
        F.col("i").cast("long").alias("ref_place"),
        F.col("turn.state.size").alias("size"),
    )
    # moved by r^(b - h): the base's head is never longer than h
    moves = [F.get(F.array(*[F.lit(pow(r, -d, PRIME)).cast("long") for d in range(heads)]), (F.col("h") - F.col("b")).cast("int")) for r in bases(attempt)]
    lead = given.where("n > h").select(
        F.col("conv_id").alias("conv"), "h", "b", *[c.alias(f"b{i}") for i, c in enumerate(sums_at(F.col("base_head"), F.col("b")))],
        *[c.alias(f"o{i}") for i, c in enumerate(sums_at(F.col("head"), F.col("h")))], *[c.alias(f"m{i}") for i, c in enumerate(moves)],
    )
    before = sums.select("conv_id", "place", "size", *[f"s{i}" for i in range(RESIDUES)])
    later = before.join(lead, (F.col("conv_id") == F.col("conv")) & (F.col("place") >= F.col("h")))

    def combined(part: Column, i: int) -> Column:
        return (F.col(f"b{i}") + F.pmod(part - F.col(f"o{i}"), F.lit(PRIME)) * F.col(f"m{i}") % PRIME) % PRIME

    # the parent's sums are those of the turn before; they are read from its row, not computed backwards
    earlier = sums.select(F.col("conv_id").alias("of"), (F.col("place") + 1).alias("next"), *[F.col(f"s{i}").alias(f"q{i}") for i in range(RESIDUES)])
    later = later.join(earlier, (F.col("conv_id") == F.col("of")) & (F.col("place") == F.col("next")), "left")
    from_own = later.select(
        "conv_id",
        (F.col("b") + F.col("place") - F.col("h") + 1).alias("depth"),
        *keys([combined(F.col(f"s{i}"), i) for i in range(RESIDUES)], "k"),
        *keys([combined(F.coalesce(f"q{i}", F.lit(0)), i) for i in range(RESIDUES)], "p"),
        F.col("conv_id").alias("ref_conv"),
        F.col("place").alias("ref_place"),
        "size",
    )
    sizes = given.select("conv_id", (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))
    return written(spark, from_base.unionByName(from_own), "passages"), sizes


def verified(spark: SparkSession, passages: DataFrame, turns: DataFrame) -> bool:
    """Whether all prefixes of a node are equal, by their parents and the turns they refer to."""
    parent = F.struct("p1", "p2")
    refs = written(spark, passages.groupBy(*NODE, "ref_conv", "ref_place").agg(F.min(parent).alias("least"), F.max(parent).alias("most")), "refs")
    nodes = refs.groupBy(*NODE).agg(F.count(F.lit(1)).alias("refs"), F.min("least").alias("least"), F.max("most").alias("most"))
    nodes = written(spark, nodes.where("refs > 1 OR least <> most").toDF("d", "q1", "q2", *nodes.columns[3:]), "nodes")
    if not nodes.where("least <> most").isEmpty():
        return False
    several = refs.join(nodes.select("d", "q1", "q2"), (F.col("depth") == F.col("d")) & (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2"))).select(*NODE, "ref_conv", "ref_place")
    shown = several.join(turns, (F.col("ref_conv") == F.col("conv_id")) & (F.col("ref_place") == F.col("place")))
    # smallest and largest are combined before the shuffle, so a node of many references is no hot key
    seen = shown.groupBy(*NODE).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("role", "text") for f in (F.min, F.max)])
    return seen.where("min_role <> max_role OR min_text <> max_text").isEmpty()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ascending ids as comma-joined text of at most ``TEXT`` ids, with the first id."""
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in range(3)]
        ids = batch.column(3)
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.flatnonzero(new)
        lengths = np.diff([*starts, batch.num_rows])
        starts = np.concatenate([np.arange(s, s + n, TEXT) for s, n in zip(starts, lengths)]) if len(starts) else starts
        texts = [",".join(map(str, ids.slice(a, b - a).to_pylist())) for a, b in zip(starts, [*starts[1:], batch.num_rows])]
        yield pa.RecordBatch.from_arrays([*[pa.array(k[starts], pa.int64()) for k in keys], ids.take(pa.array(starts, pa.int64())), pa.array(texts, pa.string())], names=[*NODE, "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces in ascending order, without holding them."""
    node, digest, done = None, None, []
    for batch in batches:
        for *key, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
            if key == node:
                digest.update(b"," + text.encode())
                continue
            if node is not None:
                done.append((*node, digest.hexdigest()))
            node, digest = key, hashlib.sha256(text.encode())
    if node is not None:
        done.append((*node, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([*[pa.array([d[i] for d in done], pa.int64()) for i in range(3)], pa.array([d[3] for d in done], pa.string())], names=[*NODE, "ends_sha256"])


def digests(ends: DataFrame) -> DataFrame:
    """ends_sha256 per node of (node, conv_id): the ids in ascending order, hashed as a stream.

    Ranges of ids become pieces of text first, so the task that hashes a node of very many members
    reads a few long rows.
    """
    key = [T.StructField(n, T.LongType()) for n in NODE]
    rows = ends.select(*NODE, F.col("conv_id").cast("long").alias("first")).repartitionByRange(*NODE, "first").sortWithinPartitions(*NODE, "first")
    pieces = rows.mapInArrow(_pieces, T.StructType([*key, T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())]))
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hashed, T.StructType([*key, T.StructField("ends_sha256", T.StringType())]))


def tree(spark: SparkSession, passages: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of ``prefix_trie`` from verified passages."""
    found = passages.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("size").alias("size"), F.min(F.struct("p1", "p2")).alias("parent")
    )
    found = written(spark, found.select("*", "parent.*").drop("parent"), "nodes")
    children = found.where("depth > 1").groupBy((F.col("depth") - 1).alias("d"), F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count(F.lit(1)).alias("n_children"))
    same = (F.col("depth") == F.col("d")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    nodes = found.join(children, same, "left").drop("d", "c1", "c2").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = written(spark, nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("size")), "nodes")

    # chains: the nodes of one smallest member, from depth e0 to the end of its conversation
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("e0"), F.sum("saved").alias("total"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("leaf")
    )
    chains = written(spark, chains, "chains")
    named = chains.select(F.col("conv_id").alias("member"), "e0", "total", "leaf")
    along = running(nodes.join(named, F.col("conv_id") == F.col("member")).withColumn("link", F.col("depth") - F.col("e0")), "conv_id", "link", {"saved": "reached"})
    other = passages.join(named.where("leaf > 0 OR total > 0"), (F.col("conv_id") == F.col("member")) & (F.col("depth") < F.col("e0")))
    others = other.groupBy(*[F.col(c).alias(f"o_{c}") for c in NODE]).agg(F.sum("total").alias("other_saved"), F.sum("leaf").alias("other_leaves"))
    parents = found.select((F.col("depth") + 1).alias("d"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    ended = passages.join(sizes.select(F.col("conv_id").alias("ended"), "turns"), (F.col("conv_id") == F.col("ended")) & (F.col("depth") == F.col("turns")))
    hashes = digests(ended.select(*NODE, "conv_id")).toDF("h0", "h1", "h2", "ends_sha256")

    def at(*names: str) -> Column:
        return (F.col("depth") == F.col(names[0])) & (F.col("k1") == F.col(names[1])) & (F.col("k2") == F.col(names[2]))

    none = F.sha2(F.lit("").cast("binary"), 256)
    below = along.join(others, at("o_depth", "o_k1", "o_k2"), "left").join(hashes, at("h0", "h1", "h2"), "left")
    below = below.join(parents, (F.col("depth") == F.col("d")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left")
    first = sizes.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("all"))
    totals = chains.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves"), F.coalesce(F.sum("total"), F.lit(0)).alias("saved"))
    tops = found.where("depth = 1").agg(F.count(F.lit(1)).alias("tops"))
    whole_tree = {**first.first().asDict(), **totals.first().asDict(), **tops.first().asDict()}
    rows = below.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == 1, F.lit(whole_tree["root"])).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("leaf") + F.coalesce("other_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("total") - F.col("reached") + F.col("saved") + F.coalesce("other_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    # the root: all conversations; those without turns end there
    turnless = digests(sizes.where("turns = 0").select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id")).first()
    root = {
        "conv_id": whole_tree["root"],
        "depth": 0,
        "parent_conv_id": None,
        "n_convs": whole_tree["all"],
        "n_children": whole_tree["tops"],
        "n_leaves": max(1, whole_tree["leaves"]),
        "saved_tokens": whole_tree["saved"],
    }
    line = spark.range(1 if whole_tree["all"] else 0).select(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in root.items()])
    return rows.unionByName(line.withColumn("ends_sha256", F.lit(turnless["ends_sha256"]) if turnless else none))


def prefix_trie(
    spark: SparkSession,
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    span: int = 100,
    heads: int = 6,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first h turns of conversation c - c % ``span`` and its own
    turns after its first h, with h = crc32(c as text) % ``heads``.
    """
    turns = placed_turns(spark, conversations, (conv_id, turn, role, text))
    attempt = 0
    while True:
        passages, sizes = prefixes(spark, fingerprinted(spark, turns, attempt), span, heads, attempt)
        if verified(spark, passages, turns):
            return tree(spark, passages, sizes)
        attempt += 1
