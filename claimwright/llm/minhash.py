"""Near duplicates by an LSH forest over MinHash signatures, confirmed on the full shingle sets.

* Every text becomes its set of distinct 5-word shingles and a signature of 128 minima. Texts
  with equal sets form a class, represented by its smallest id.
* The forest holds 32 orders of the signature. In each, documents are sorted by their minima in
  that order; those that share the first four are a region, the rest sorts them by the length of
  the prefix that they have in common. Rows of regions with a single document are not moved: a
  count of the bare region keys makes a bitmap that holds them back.
* Range partitions of the sorted orders pair each document with the next one of another component
  among its neighbours, if sizes and signatures allow. A document gives at most one pair per order
  and round. Pairs are confirmed on whole sets and collapse into components: first from a few
  orders, then from all. So groups of near copies become one component through their longest
  common prefixes, and the depth at which a region is done follows from what it holds.
* Regions that are still open, with documents of several components, are completed: there every
  document meets those of other components, in blocks of bounded size, and is paired with its
  nearest ones. Where one component fills a region, only the others meet it. Documents that had
  more partners than were paired are compared with all of them, where both sides meet: blocks get
  the texts, each pair is looked at in the first order it shares, nearest first, and only links
  between components leave a task.

A pair with similarity 0.75 shares no region with probability (1 - 0.75^4)^32 = 5e-6, and has fewer
than 72 of 128 equal minima, or 78 that agree in two bits, with probability below 2e-6; these can
only miss a link, none is added, as each is confirmed.

Null texts and texts without words have empty sets, no links, and are kept. A null id takes no
part and is kept, with no component. Repeated rows belong to one class. Rows that share an id
are one document to the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .columns import free_name
from .components import arrow_batches, components, written

MINIMA = 128
ORDERS = 32
DEPTH = 4  # minima that a region shares
LENGTH = 12  # minima that an order sorts by
FIRST_ORDERS = 8  # of the first round
NEIGHBOURS = 4  # following documents of a sorted order that are looked at
LEAST_EQUAL = 72  # of the minima, for a candidate
LEAST_BITS = 78  # of the minima's last two bits
BLOCK = 1024  # documents of a region compared at once
TEXT_BLOCK = 256  # the same with their texts
PARTNERS = 2  # nearest partners paired per document and region
TEXT_ROWS, TEXT_BYTES = 1024, 8 << 20  # texts, or pairs of texts, in one Arrow batch
SIEVE_BITS = 1 << 24
BLOCK_KEY = ("key", "low", "high")
WINDOW = 5


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; overflow wraps."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a UTF-8 text."""
    words = (text or b"").lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(WINDOW, len(words))
    if not width:
        return hashes
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - width + 1 + k]
    return np.unique(_mixed(rolled))


def _parameters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    multipliers = rng.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, MINIMA, dtype=np.uint64)
    first = np.arange(ORDERS * DEPTH).reshape(ORDERS, DEPTH)
    rest = np.stack([rng.permutation(np.setdiff1d(np.arange(MINIMA), own))[: LENGTH - DEPTH] for own in first])
    return multipliers, offsets, np.hstack([first, rest])


MULTIPLIERS, OFFSETS, FOREST = _parameters()


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(MINIMA, 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = (shingles[at : at + 2048, None] * MULTIPLIERS + OFFSETS) >> np.uint64(32)
        np.minimum(least, part.min(axis=0), out=least)
    return least


def sort_keys(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per order the key of the region, and the further minima as eight bytes that sort in their order."""
    heads, tails = [], []
    for order, places in enumerate(FOREST):
        key = np.full(len(signatures), order + 1, np.uint64)
        for depth, place in enumerate(places[:DEPTH], 1):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, place] + np.uint64(depth))
        tail = np.zeros(len(signatures), np.uint64)
        for place in places[DEPTH:]:
            tail = (tail << np.uint64(8)) | (signatures[:, place] & np.uint64(255))
        heads.append(key)
        tails.append(tail)
    empty = np.zeros((0, ORDERS), np.uint64)
    return (np.stack(heads, axis=1), np.stack(tails, axis=1)) if len(signatures) else (empty, empty)


def two_bits(signatures: np.ndarray) -> np.ndarray:
    """The last two bits of all minima, packed."""
    quarter = (signatures & np.uint64(3)).astype(np.uint8).reshape(len(signatures), -1, 4)
    return quarter[:, :, 0] | quarter[:, :, 1] << 2 | quarter[:, :, 2] << 4 | quarter[:, :, 3] << 6


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima agree in their last two bits."""
    apart = a ^ b
    return MINIMA - np.bitwise_count((apart | apart >> 1) & 0x55).sum(axis=1, dtype=np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sizes, classes, rows = [], [], []
            for text in part.column(1):
                shingles = shingle_set(text.as_py())
                sizes.append(len(shingles))
                classes.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                rows.append(minima(shingles))
            signatures = np.array(rows, np.uint64).reshape(-1, MINIMA)
            offsets = pa.array(np.arange(0, len(rows) * ORDERS + 1, ORDERS, dtype=np.int32))
            keys, tails = (pa.ListArray.from_arrays(offsets, pa.array(k.view(np.int64).ravel())) for k in sort_keys(signatures))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    keys,
                    tails,
                    pa.array([r.tobytes() for r in signatures.astype(np.uint8)], pa.binary()),
                    pa.array([r.tobytes() for r in two_bits(signatures)], pa.binary()),
                ],
                names=["id", "n_shingles", "class", "keys", "tails", "signature", "bits"],
            )


def signed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size of the shingle set, its class, the keys of all orders, and the minima's last bytes and bits."""
    rows = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("class", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("tails", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
            T.StructField("bits", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(_signed, schema)


def sizes_allow(a: str, b: str):
    return 100 * F.least(a, b) >= 75 * F.greatest(a, b)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, MINIMA) for n in ("signature_a", "signature_b"))
        yield batch.filter(pa.array((a == b).sum(axis=1) >= LEAST_EQUAL)).select(["a", "b"])


def forest_rows(members: DataFrame) -> DataFrame:
    """One row per document and order in a region that others may share: tree, key, tail, id, n_shingles, bits."""
    keys = members.select(F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    both = F.transform(F.arrays_zip("keys", "tails"), lambda k, i: F.struct(i.alias("tree"), k["keys"].alias("key"), k["tails"].alias("tail")))
    rows = members.select("id", "n_shingles", "bits", F.explode(both).alias("at")).select("at.*", "id", "n_shingles", "bits")
    return sieved(rows, shared, "key")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted order with the next one of another component that may be similar."""
    held = None
    for batch in batches:
        known = 0 if held is None else held.num_rows
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table.num_rows:
            continue
        rows = table.to_batches()[0]
        key, component, size = (rows[n].to_numpy() for n in ("key", "component", "n_shingles"))
        bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(-1, MINIMA // 4)
        todo, found = np.arange(len(key)), []
        for step in range(1, NEIGHBOURS + 1):
            todo = todo[todo + step < len(key)]
            other = todo + step
            fits = (key[todo] == key[other]) & (component[todo] != component[other]) & (other >= known)
            fits &= 100 * np.minimum(size[todo], size[other]) >= 75 * np.maximum(size[todo], size[other])
            i, j = todo[fits], other[fits]
            near = agreeing(bits[i], bits[j]) >= LEAST_BITS
            found.append((i[near], j[near]))
            todo = np.setdiff1d(todo, i[near], assume_unique=True)
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        yield pa.RecordBatch.from_arrays(_ordered(rows, i, j), names=["a", "b"])
        held = rows.slice(max(0, rows.num_rows - NEIGHBOURS))


def neighbour_candidates(rows: DataFrame) -> DataFrame:
    """Pairs of neighbours in the sorted orders; ``rows`` have a component."""
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    # bytes sort as unsigned numbers
    order = ["key", F.col("tail").bitwiseXOR(F.lit(-(2**63))), "id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("key", "id", "component", "n_shingles", "bits").mapInArrow(_neighbours, schema).distinct()


def alike(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs whose signatures allow the similarity."""
    signatures = members.select("id", "signature")
    with_both = pairs.join(signatures.toDF("b", "signature_b"), "b").join(signatures.toDF("a", "signature_a"), "a")
    return with_both.select("a", "b", "signature_a", "signature_b").mapInArrow(_alike, pairs.schema)


def _paired(rows: pa.RecordBatch, wanted=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one block that may be similar and differ in component, with their equal minima.

    ``wanted(i, j)`` can rule out further pairs before signatures are compared.
    """
    block = np.zeros(rows.num_rows, np.int64)
    for name in BLOCK_KEY:
        values = rows[name].to_numpy()
        block[1:] |= values[1:] != values[:-1]
    block = np.cumsum(block)
    component, size, part = (rows[n].to_numpy() for n in ("component", "n_shingles", "part"))
    # parts of -1 are in every block of a region that one component fills; among themselves they meet in one
    low = rows["low"].to_numpy()
    within = low == rows["high"].to_numpy()
    guest = part < 0
    bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(-1, MINIMA // 4)
    found, step, at = [np.zeros((3, 0), np.int64)], 1, np.arange(rows.num_rows - 1)
    while len(at):
        at = at[at + step < len(block)]
        at = at[block[at] == block[at + step]]
        other = at + step
        fits = (component[at] != component[other]) & (within[at] | (part[at] != part[other])) & ~(guest[at] & guest[other] & (low[at] > 0))
        fits &= 100 * np.minimum(size[at], size[other]) >= 75 * np.maximum(size[at], size[other])
        i, j = at[fits], other[fits]
        if wanted is not None:
            keep = wanted(i, j)
            i, j = i[keep], j[keep]
        equal = agreeing(bits[i], bits[j])
        keep = equal >= LEAST_BITS
        found.append(np.stack([i[keep], j[keep], equal[keep]]))
        step += 1
    return tuple(np.concatenate(found, axis=1))


def _ordered(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray) -> list[pa.Array]:
    a, b = rows["id"].take(pa.array(i)), rows["id"].take(pa.array(j))
    smaller = pc.less_equal(a, b)
    return [pc.if_else(smaller, a, b), pc.if_else(smaller, b, a)]


def _nearest(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Each row with its nearest partners; a row that has more comes with itself besides."""
    i, j, equal = _paired(rows)
    row, pair, near = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2), np.tile(equal, 2)
    order = np.lexsort((pair, -near, row))
    rank = np.arange(len(order)) - np.searchsorted(row[order], row[order])
    chosen = np.unique(pair[order][rank < PARTNERS])
    crowded = np.unique(row[order][rank >= PARTNERS])
    return pa.RecordBatch.from_arrays(_ordered(rows, np.concatenate([i[chosen], crowded]), np.concatenate([j[chosen], crowded])), names=["a", "b"])


def _dense(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Confirmed links between components, for pairs with a crowded row, each in its first shared order."""
    keys = np.asarray(rows["keys"].flatten()).reshape(-1, ORDERS)
    key, crowded, component = rows["key"].to_numpy(), rows["crowded"].to_numpy(zero_copy_only=False), rows["component"].to_pylist()

    def wanted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        first = (keys[i] == keys[j]).argmax(axis=1)
        return (crowded[i] | crowded[j]) & (keys[i, first] == key[i])

    i, j, equal = _paired(rows, wanted)
    parent: dict = {}

    def root(x):
        while x in parent:
            x = parent[x]
        return x

    sets: dict[int, set] = {}

    def shingles(row: int) -> set:
        if row not in sets:
            sets[row] = set(shingle_set(rows["text"][row].as_py()).tolist())
        return sets[row]

    linked = []
    for pair in np.argsort(-equal, kind="stable").tolist():
        x, y = int(i[pair]), int(j[pair])
        left, right = root(component[x]), root(component[y])
        if left != right:
            shared = len(shingles(x) & shingles(y))
            if 100 * shared >= 75 * (len(sets[x]) + len(sets[y]) - shared):
                parent[left] = right
                linked.append((x, y))
    return pa.RecordBatch.from_arrays(_ordered(rows, *np.array(linked, np.int64).reshape(-1, 2).T), names=["a", "b"])


def _by_blocks(body):
    """Applies ``body`` to batches of whole blocks; the rows come sorted by block."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last block, which may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            rows = table.to_batches()[0]
            last = np.ones(rows.num_rows, bool)
            for name in BLOCK_KEY:
                values = rows[name].to_numpy()
                last &= values == values[-1]
            cut = int(last.argmax())
            if cut:
                yield body(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield body(held)

    return apply


def open_regions(rows: DataFrame) -> DataFrame:
    """key, n, and the component ``most`` with its ``held`` rows of regions with several components."""
    held = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    largest = F.max(F.struct("held", "component")).alias("largest")
    found = held.groupBy("key").agg(F.sum("held").alias("n"), F.count(F.lit(1)).alias("components"), largest).where("components > 1")
    return found.select("key", "n", F.col("largest.held").alias("held"), F.col("largest.component").alias("most"))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows with their region's n, held and most, dealt into blocks where rows of different components meet.

    If all but one component fit a block, they are guests of every part of that one. Otherwise all
    parts meet each other.
    """
    filled = F.col("n") - F.col("held") <= F.lit(block)
    guest = filled & (F.col("component") != F.col("most"))
    parts = F.when(filled, F.ceil(F.col("held") / block)).otherwise(F.ceil(F.col("n") / block)).cast("int")
    dealt = rows.withColumns({"parts": parts, "filled": filled, "guest": guest}).withColumn(
        "part", F.when(F.col("guest"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int"))
    )
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    blocks = F.when(F.col("guest") | ~F.col("filled"), every).otherwise(F.array("part"))
    met = dealt.withColumn("other", F.explode(blocks))
    home = F.col("filled")
    low, high = F.when(home, F.col("other")).otherwise(F.least("part", "other")), F.when(home, F.col("other")).otherwise(F.greatest("part", "other"))
    return met.withColumns({"low": low, "high": high}).drop("n", "held", "most", "parts", "filled", "guest", "other")


def with_components(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))


def crossing_candidates(rows: DataFrame) -> DataFrame:
    """Nearest pairs (a, b) of different components in open regions.

    A document with more partners than are paired comes as a pair with itself.
    """
    blocks = _blocks(rows.select("key", "id", "component", "n_shingles", "bits").join(open_regions(rows), "key"), BLOCK)
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return blocks.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).mapInArrow(_by_blocks(_nearest), schema).distinct()


def dense_links(rows: DataFrame, members: DataFrame, crowded: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Confirmed links of crowded documents (column id) to other components, found within the blocks."""
    marked = rows.select("key", "id", "component", "n_shingles").join(crowded.select(F.col("id").alias("node_id"), F.lit(True).alias("crowded")), F.col("id") == F.col("node_id"), "left")
    marked = marked.drop("node_id").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    any_ = marked.where("crowded").select("key").distinct()
    shared = marked.join(any_, "key", "left_semi").join(open_regions(marked), "key")
    texts = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    texts = sieved(texts, shared.select("id")).toDF("text_id", "text")
    known = members.select(F.col("id").alias("of"), "bits", "keys")
    full = _blocks(shared, TEXT_BLOCK).join(known, F.col("id") == F.col("of")).drop("of").join(texts, F.col("id") == F.col("text_id")).drop("text_id")
    kind = members.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return full.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).mapInArrow(_by_blocks(_dense), schema)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, own = None, None
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("text_a"), batch.column("text_b")):
            if last is None or a != last:
                last, own = a, shingle_set(a.as_py())
            other = shingle_set(b.as_py())
            shared = len(np.intersect1d(own, other, assume_unique=True))
            keep.append(100 * shared >= 75 * (len(own) + len(other) - shared))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def sieved(rows: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The rows whose ``column`` may be among ``ids``: all that are and few others.

    A bitmap of hashed ids is broadcast. It never exceeds SIEVE_BITS / 8 bytes; with many more
    ids it only lets more rows pass.
    """

    def place(column: str):
        return F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS).cast("long"))

    sieve = ids.select(place(column).alias("place"))
    sieve = sieve.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("sieve"))
    placed = rows.withColumn("place", place(column))
    byte = F.conv(F.hex(F.substring("sieve", (F.bitmap_bit_position("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(place) % 8 as int))"))
    return placed.join(F.broadcast(sieve), F.bitmap_bucket_number("place") == F.col("bucket")).where(bit != 0).drop("place", "bucket", "sieve")


def confirmed(pairs: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The pairs whose whole shingle sets reach the similarity."""
    texts = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    texts = sieved(texts, pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    return both.mapInArrow(_confirmed, pairs.schema)


def near_duplicates(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id and kept."""
    with arrow_batches(spark, TEXT_ROWS, TEXT_BYTES):
        return _near_duplicates(spark, documents, doc_id, text)


def _near_duplicates(spark: SparkSession, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = written(spark, signed(documents, doc_id, text), "signed")
    classes = rows.where(F.col("class").isNotNull() & F.col("id").isNotNull()).groupBy("class").agg(F.min("id").alias("first"))
    members = rows.join(classes.withColumnRenamed("first", "id"), ["class", "id"], "left_semi")
    forest = written(spark, forest_rows(members), "forest")
    # a few orders first, then all of them between what is not yet one component
    first = forest.where(F.col("tree") < FIRST_ORDERS).withColumn("component", F.col("id"))
    tested = written(spark, alike(neighbour_candidates(first), members), "candidates")
    found = components(spark, confirmed(tested, documents, doc_id, text))
    further = neighbour_candidates(with_components(forest, found)).join(tested, ["a", "b"], "left_anti")
    further = written(spark, alike(further, members), "candidates")
    found = components(spark, found.toDF("a", "b").unionByName(confirmed(further, documents, doc_id, text)))
    # open regions to the end
    crossing = written(spark, crossing_candidates(with_components(forest, found)), "candidates")
    tested = tested.unionByName(further)
    nearest = alike(crossing.where("a <> b").join(tested, ["a", "b"], "left_anti"), members)
    found = components(spark, found.toDF("a", "b").unionByName(confirmed(nearest, documents, doc_id, text)))
    crowded = crossing.where("a = b").select(F.col("a").alias("id"))
    if not crowded.isEmpty():
        found = components(spark, found.toDF("a", "b").unionByName(dense_links(with_components(forest, found), members, crowded, documents, doc_id, text)))
    named = classes.join(found, F.col("first") == F.col("id"), "left").select(F.col("class").alias("of"), F.coalesce("component", "first").alias("component"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(named, F.col("class") == F.col("of"), "left").select(
        "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(spark: SparkSession, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group; rows that repeat an id and text are one document."""
    judged = near_duplicates(spark, documents, doc_id, text)
    gone = free_name(documents.columns, "gone")
    removed = judged.groupBy(F.col("id").alias(gone)).agg(F.max("kept").alias("kept")).where("not kept").select(gone)
    return documents.join(removed, F.col(f"`{doc_id}`") == F.col(gone), "left_anti").dropDuplicates([doc_id, text])
