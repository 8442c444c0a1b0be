"""Connected components of an edge table, by alternating large and small stars.

Every step is a minimum per node and a join, so a node with very many neighbours is combined
before it is shuffled and its rows are split by the skew join. Steps are written to the shared
folder; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from claimwright.session import scratch_path


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """At most so many rows and about so many bytes in an Arrow batch, for steps that run within.

    Whole texts make large batches; a single longer row is a batch of its own.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name) for name in limits}
    for name, limit in limits.items():
        known = int(before[name].rstrip("b"))
        spark.conf.set(name, str(min(limit, known) if known > 0 else limit))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, which cuts its lineage."""
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's greater neighbours are tied to its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) of every node that is not the least of its component.

    ``edges`` has columns a and b; order, repeats and loops do not matter.
    """
    edges = written(spark, edges.where("a <> b").select("a", "b").distinct(), "stars")
    seen = None
    while True:
        # both steps read their input several times, so each reads a table
        large = written(spark, large_star(edges).where("a <> b").distinct(), "stars")
        step = small_star(large).where("a <> b").distinct()
        observed = Observation()
        edges = written(spark, step.observe(observed, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")), "stars")
        state = observed.get
        if state == seen:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = state
