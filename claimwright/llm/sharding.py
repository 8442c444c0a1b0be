"""Shards of equal bytes from indivisible groups, by Karmarkar-Karp differencing.

Documents with equal texts are a group and stay together. Every group starts as a partial
partition with its bytes in one of the shards and nothing in the others. Differencing repeatedly
takes the two partial partitions with the largest spread and adds them oppositely ordered, the
largest part of one to the smallest of the other. Buckets of bounded size do this in parallel
until each is one partial partition; the buckets' partitions are the items of the next round,
until one is left. Shards follow by applying the orders from the last round back to the groups.

A group is summed before it is shuffled, so copies cost nothing. A group larger than an even
share makes its shard as large as itself. Null texts are one group of size 1 per row, empty ones
another. Repeated rows are further rows of their group; null ids are allowed.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F, types as T

from .components import written

BUCKET = 10_000  # partial partitions differenced in one task
SLOTS = 50_000  # rows numbered in one task
RUN = 4_096  # equal rows that come back from one


def differenced(vectors: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """For each vector, the final place of each of its parts; and the sums of the final places."""
    shards = len(vectors[0])
    heap = [(min(v) - max(v), i) for i, v in enumerate(vectors)]
    heapq.heapify(heap)
    sums, made = list(vectors), {}
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        down = sorted(range(shards), key=lambda i: -sums[a][i])
        up = sorted(range(shards), key=lambda i: sums[b][i])
        joined = [sums[a][x] + sums[b][y] for x, y in zip(down, up)]
        made[len(sums)] = (a, down, b, up)
        heapq.heappush(heap, (min(joined) - max(joined), len(sums)))
        sums.append(joined)
    places = {heap[0][1]: list(range(shards))}
    for node in sorted(made, reverse=True):
        a, down, b, up = made[node]
        own = places.pop(node)
        for child, order in ((a, down), (b, up)):
            place = [0] * shards
            for to, part in enumerate(order):
                place[part] = own[to]
            places[child] = place
    return [places[i] for i in range(len(vectors))], sums[heap[0][1]]


def _bucket(key, rows):
    import pandas as pd

    rows = rows.sort_values("item")
    places, total = differenced([[int(x) for x in v] for v in rows.sums])
    return pd.DataFrame({"item": rows.item, "places": places, "bucket": int(key[0]), "total": [total] * len(rows)})


def balanced(spark: SparkSession, groups: DataFrame, shards: int) -> DataFrame:
    """(item, shard) for groups with columns item and bytes."""
    parts = F.array(F.col("bytes"), *[F.lit(0).cast("long")] * (shards - 1))
    items, rounds = groups.select("item", parts.alias("sums")), []
    count = groups.count()
    longs = T.ArrayType(T.LongType())
    while True:
        buckets = -(-max(count, 1) // BUCKET)
        schema = T.StructType([T.StructField("item", items.schema["item"].dataType), T.StructField("places", longs), T.StructField("bucket", T.LongType()), T.StructField("total", longs)])
        solved = written(spark, items.groupBy(F.pmod(F.xxhash64("item"), F.lit(buckets).cast("long")).alias("b")).applyInPandas(_bucket, schema), "differenced")
        rounds.append(solved)
        if buckets == 1:
            break
        items, count = solved.groupBy(F.col("bucket").alias("item")).agg(F.first("total").alias("sums")), buckets
    found = rounds[0].select("item", "bucket", F.element_at("places", 1).alias("shard"))
    for outer in rounds[1:]:
        above = outer.select(F.col("item").alias("inner"), "places", F.col("bucket").alias("outer"))
        found = found.join(above, F.col("bucket") == F.col("inner")).select("item", F.col("outer").alias("bucket"), F.get("places", F.col("shard").cast("int")).alias("shard"))
    return found.select("item", F.col("shard").cast("int").alias("shard"))


def numbered(rows: DataFrame, shard: str, order: list[Column], alias: str = "slot") -> DataFrame:
    """Adds a number from 0 without gaps within each shard, without one task per shard.

    Equal rows are counted, numbered as one and brought back in runs, wherever those lie. Other rows
    must differ in ``order``.
    """
    names = rows.columns
    pieces = -(-max(rows.count(), 1) // SLOTS)
    distinct = rows.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("__n"))
    placed = distinct.withColumn("__piece", F.pmod(F.xxhash64(*order), F.lit(pieces).cast("long")))
    counts = placed.groupBy(shard, "__piece").agg(F.sum("__n").alias("__held"))

    def earlier(value: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))

    starts = counts.select(shard, "__piece", earlier("__held", Window.partitionBy(shard).orderBy("__piece")).alias("__start"))
    ranked = placed.withColumn("__before", earlier("__n", Window.partitionBy(shard, "__piece").orderBy(*order)))
    runs = ranked.join(starts, [shard, "__piece"]).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {RUN}"))))
    spread = runs.repartition(F.xxhash64(*order, "__run"))
    first = F.col("__run") * RUN
    number = F.explode(F.sequence(first, F.least(first + RUN, F.col("__n")) - 1))
    numbers = spread.withColumn("__i", number).withColumn(alias, F.col("__start") + F.col("__before") + F.col("__i"))
    return numbers.select(*[F.col(f"`{c}`") for c in names], alias)


def shard_documents(spark: SparkSession, documents: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot."""
    value = F.col(f"`{text}`").cast("string")
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(value, F.lit(""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(value)), F.lit(b"")).alias("item"),
    )
    rows = written(spark, rows, "sizes")
    groups = rows.groupBy("item").agg(F.sum("size").alias("bytes"))
    placed = written(spark, rows.join(balanced(spark, groups, shards), "item"), "placed")
    return numbered(placed, "shard", [F.col("doc_id"), F.col("item")]).select("doc_id", "size", "text_crc32", "shard", "slot")
