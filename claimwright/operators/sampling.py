"""Exact, repeatable sampling and splitting.

Units are ordered by a seeded integer key of their content. The last of the k smallest is found in
two scans: counts of key buckets give its bucket, the rows of that bucket (about one in a million)
its key and itself. Membership is then a comparison of key and row, in the pass that reads the
result anyway. No row order, no random state per task: a recomputed partition gives the same answer.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import columns as fx
from ..session import shared_folder
from .clean import require_columns

log = logging.getLogger(__name__)

BUCKET_SHIFT = 11  # keys have 31 bits, so there are 2**20 buckets
DIRECT_LIMIT = 1_000  # up to here a plain top-k, of as many rows from every partition, is cheapest
INLINE_STRATA = 10_000  # strata whose cut points may travel as a broadcast table
COPIES_PER_ROW = 65_536
TIED_ROWS = 2_000_000  # rows of one cut bucket that may be ordered in one task


def _bucket(key: str) -> Column:
    return F.shiftright(F.col(key), BUCKET_SHIFT).cast("int")


def semi_join_ids(df: DataFrame, column: str, ids: DataFrame | Sequence) -> DataFrame:
    """Rows whose value is in ``ids``: a list becomes a pushed-down IN, a DataFrame a semi join."""
    if isinstance(ids, DataFrame):
        values = ids.select(ids[ids.columns[0]].alias("__id")).distinct()
        return df.join(values, fx.quoted(column) == F.col("__id"), "left_semi")
    return df.filter(fx.quoted(column).isin(list(ids)))


def sample_by_key(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of ``n`` randomly chosen ids; all rows if there are no more than ``n`` ids.

    The choice reduces to one cut point (key, id), so the rows are picked by a filter: no join,
    and an id with a third of all rows needs no special care.
    """
    require_columns(df, [id_column])
    ids = df.select(fx.quoted(id_column).alias("id")).distinct()
    ids = ids.withColumn("key", fx.row_key(ids, ["id"], seed))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        ids.groupBy(_bucket("key").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .filter((F.col("upto") >= n) & (F.col("upto") - F.col("n") < n))
        .first()
    )
    if cut is None:
        if n > 0:
            log.warning("sample size %d exceeds the number of ids; using all of them", n)
            return df
        return df.limit(0)
    need = n - (cut["upto"] - cut["n"])
    order = [F.col("key"), F.col("id").asc_nulls_first()]
    last = (
        ids.filter(_bucket("key") == cut["bucket"])
        .orderBy(*order)
        .limit(need)
        .orderBy(F.col("key").desc(), F.col("id").desc_nulls_last())
        .first()
    )
    key, value = fx.row_key(df, [id_column], seed), fx.quoted(id_column)
    not_after = value.isNull() if last["id"] is None else value.isNull() | (value <= last["id"])
    return df.filter((key < last["key"]) | ((key == last["key"]) & not_after))


def sample_rows(df: DataFrame, n: int, key_columns: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows. Identical rows are interchangeable."""
    names = list(key_columns or df.columns)
    if n <= DIRECT_LIMIT:
        keyed = df.withColumn("__key", fx.row_key(df, names, seed))
        return keyed.orderBy("__key", *[fx.quoted(c) for c in df.columns]).limit(n).drop("__key")
    return _tag_smallest(df, names, None, seed, count=n).filter("__picked").drop("__picked")


def _quotas(totals: DataFrame, share: float | None, count: int | None) -> DataFrame:
    """How many rows each stratum gives: largest remainders, so that the sum is exact.

    ``totals`` has one row per stratum.
    """
    everything = Window.partitionBy()
    by_remainder = Window.orderBy(F.col("part").desc(), F.col("stratum").asc_nulls_first())
    asked = F.ceil(F.col("rows") * F.lit(share)) if count is None else F.least(F.lit(count), F.col("rows"))
    return (
        totals.withColumn("rows", F.sum("total").over(everything))
        .withColumn("asked", asked.cast("bigint"))
        .withColumn("ideal", F.col("total").cast("double") * F.col("asked").cast("double") / F.col("rows").cast("double"))
        .withColumn("whole", F.floor("ideal").cast("bigint"))
        .withColumn("part", F.col("ideal") - F.col("whole"))
        .withColumn("left", F.col("asked") - F.sum("whole").over(everything))
        .withColumn("place", F.row_number().over(by_remainder))
        .select("stratum", (F.col("whole") + (F.col("place") <= F.col("left")).cast("int")).alias("quota"))
    )


def repeat_rows(df: DataFrame, count_column: str) -> DataFrame:
    """Each row ``count_column`` times. Large counts are cut up and spread before they expand."""
    parts = df.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({count_column} - 1) div {COPIES_PER_ROW}"))))
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(spread, "__part")
    here = F.least(F.lit(COPIES_PER_ROW).cast("bigint"), F.col(count_column) - F.col("__part") * COPIES_PER_ROW)
    return parts.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), here))).drop("__part", "__i", count_column)


def _running_total(tied: DataFrame, order: list, spread: bool) -> DataFrame:
    """Add ``__before``: the rows of the same stratum that come earlier in the order.

    Rows of one key are few unless it holds a large share of the table. Then the rows are range
    partitioned in that order, fixed by a checkpoint, and ranked per partition on top of the
    totals of the partitions before.
    """
    if not spread:
        running = Window.partitionBy("__stratum").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return tied.withColumn("__before", F.sum("__n").over(running) - F.col("__n"))
    shared_folder(tied.sparkSession)
    parts = int(tied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        tied.repartitionByRange(parts, F.col("__stratum").asc_nulls_first(), *order)
        .withColumn("__part", F.spark_partition_id())
        .checkpoint()
    )
    earlier = Window.partitionBy("__stratum").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__stratum", "__part")
        .agg(F.sum("__n").alias("__held"))
        .select(
            F.col("__stratum").alias("__s"),
            F.col("__part").alias("__p"),
            F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__offset"),
        )
    )
    running = Window.partitionBy("__stratum", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("__before", F.sum("__n").over(running) - F.col("__n"))
    same = local["__stratum"].eqNullSafe(offsets["__s"]) & (local["__part"] == offsets["__p"])
    # no hint: a few rows per stratum and partition, broadcast when their measured size allows
    return local.join(offsets, same).withColumn("__before", F.col("__before") + F.col("__offset")).drop(
        "__s", "__p", "__offset", "__part"
    )


def _tag_smallest(
    df: DataFrame,
    key_columns: Sequence[str],
    stratum: str | None,
    seed: int,
    share: float | None = None,
    count: int | None = None,
) -> DataFrame:
    """Add boolean ``__picked``: the ``share`` (or ``count``) rows with the smallest keys, per stratum."""
    require_columns(df, [*key_columns, *([stratum] if stratum else [])])
    label = fx.quoted(stratum) if stratum else F.lit(0)
    keyed = df.withColumns({"__key": fx.row_key(df, key_columns, seed), "__stratum": label})
    keyed = keyed.withColumn("__bucket", _bucket("__key"))
    counts = keyed.groupBy(F.col("__stratum").alias("stratum"), F.col("__bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    quotas = _quotas(counts.groupBy("stratum").agg(F.sum("n").alias("total")), share, count)
    running = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("upto", F.sum("n").over(running))
    same = upto["stratum"].eqNullSafe(quotas["stratum"])
    cuts = (
        upto.join(quotas, same)
        .filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select(
            upto["stratum"].alias("__at"),
            F.col("bucket").alias("__cut"),
            F.col("n").alias("__size"),
            (F.col("quota") - F.col("upto") + F.col("n")).alias("__need"),
        )
    )
    spark = df.sparkSession
    if stratum is None:
        cut = cuts.first()
        at, need, largest = (cut["__cut"], cut["__need"], cut["__size"]) if cut else (-1, 0, 0)
        marked = keyed.withColumns({"__cut": F.lit(at), "__need": F.lit(need).cast("bigint")})
    else:
        short = cuts.limit(INLINE_STRATA + 1).collect()
        if len(short) <= INLINE_STRATA:
            largest = max((r["__size"] for r in short), default=0)
            cuts = F.broadcast(spark.createDataFrame(short, cuts.schema))
        else:
            shared_folder(spark)
            cuts = cuts.checkpoint()
            largest = cuts.agg(F.max("__size")).first()[0]
        marked = keyed.join(cuts, keyed["__stratum"].eqNullSafe(cuts["__at"]), "left").withColumns(
            {"__cut": F.coalesce("__cut", F.lit(-1)), "__need": F.coalesce("__need", F.lit(0).cast("bigint"))}
        )
    rows = [fx.quoted(c) for c in df.columns]
    tied = (
        marked.filter(F.col("__bucket") == F.col("__cut"))
        .groupBy("__stratum", "__need", "__key", *rows)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    edges = _edges(tied, rows, spread=largest > TIED_ROWS)
    # apart from the edge rows themselves, a row is picked or not by a comparison
    if stratum is None:
        found = edges.select("__edge_key").first()
        last = F.lit(found["__edge_key"] if found else -1)
        judged = keyed.join(F.broadcast(edges), F.col("__key") == F.col("__edge_key"), "left")
    else:
        last = F.coalesce("__edge_key", F.lit(-1))
        few = F.broadcast(edges) if len(short) <= INLINE_STRATA else edges
        judged = keyed.join(few, keyed["__stratum"].eqNullSafe(edges["__at"]), "left")
    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(rows)])
    at_edge = F.col("__key") == last
    same = at_edge & (row == F.col("__edge"))
    divided = edges.filter("__take < __copies")
    picked = (F.col("__key") < last) | (at_edge & (row <= F.col("__edge")))
    if divided.isEmpty():
        return judged.select(*rows, picked.alias("__picked"))
    # copies of an edge row are interchangeable: they leave the table and come back by number
    whole = judged.filter(~F.coalesce(same & F.expr("__take < __copies"), F.lit(False)))
    shares = F.array(
        F.struct(F.lit(True).alias("picked"), F.col("__take").alias("n")),
        F.struct(F.lit(False).alias("picked"), (F.col("__copies") - F.col("__take")).alias("n")),
    )
    names = [F.col(f"__edge.c{i}").alias(c) for i, c in enumerate(df.columns)]
    copies = divided.select(*names, F.explode(shares).alias("__s")).select(
        *rows, F.col("__s.picked").alias("__picked"), F.col("__s.n").alias("__n")
    )
    return whole.select(*rows, picked.alias("__picked")).unionByName(repeat_rows(copies, "__n"))


def _edges(tied: DataFrame, rows: list[Column], spread: bool) -> DataFrame:
    """The last row that is picked of each stratum, fixed by a checkpoint.

    ``tied`` holds the different rows of each stratum's cut bucket with their number. The key of
    the edge follows from counts per key, at most 2**11 of them; only its rows are ordered.
    Columns: __at (stratum), __edge_key, __edge (the row), __copies of it and how many to __take.
    """
    keys = Window.partitionBy("__stratum").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        tied.groupBy("__stratum", "__need", "__key")
        .agg(F.sum("__n").alias("__held"))
        .withColumn("__upto", F.sum("__held").over(keys))
        .filter((F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__held") < F.col("__need")))
        .select(
            F.col("__stratum").alias("__at"),
            F.col("__key").alias("__edge_key"),
            (F.col("__need") - F.col("__upto") + F.col("__held")).alias("__rest"),
        )
    )
    same = F.col("__stratum").eqNullSafe(F.col("__at")) & (F.col("__key") == F.col("__edge_key"))
    ranked = _running_total(tied.join(cut, same), [c.asc_nulls_first() for c in rows], spread)
    shared_folder(tied.sparkSession)
    return (
        ranked.filter((F.col("__before") < F.col("__rest")) & (F.col("__before") + F.col("__n") >= F.col("__rest")))
        .select(
            "__at",
            "__edge_key",
            F.struct(*[c.alias(f"c{i}") for i, c in enumerate(rows)]).alias("__edge"),
            F.col("__n").alias("__copies"),
            (F.col("__rest") - F.col("__before")).alias("__take"),
        )
        .checkpoint()
    )


def tag_test_rows(
    df: DataFrame,
    test_size: float = 0.2,
    key_columns: Sequence[str] | None = None,
    stratum: str | None = None,
    seed: int = 42,
    flag: str = "is_test",
) -> DataFrame:
    """All rows with a boolean ``flag``; exactly ``ceil(rows * test_size)`` of them are true."""
    names = list(key_columns or df.columns)
    return _tag_smallest(df, names, stratum, seed, share=test_size).withColumnRenamed("__picked", flag)


def train_test_split(
    df: DataFrame, test_size: float = 0.2, key_columns: Sequence[str] | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test). ``key_columns`` default to all columns."""
    tagged = tag_test_rows(df, test_size, key_columns, None, seed, "__test")
    return tagged.filter("NOT __test").drop("__test"), tagged.filter("__test").drop("__test")


def stratified_split(
    df: DataFrame, stratum: str, test_size: float = 0.2, key_columns: Sequence[str] | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with every stratum represented by its share of the rows."""
    tagged = tag_test_rows(df, test_size, key_columns, stratum, seed, "__test")
    return tagged.filter("NOT __test").drop("__test"), tagged.filter("__test").drop("__test")


def k_folds(
    df: DataFrame, k: int = 5, key_columns: Sequence[str] | None = None, seed: int = 42, fold_column: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1, for ``CrossValidator(foldCol=...)``."""
    key = fx.row_key(df, list(key_columns or df.columns), seed)
    return df.withColumn(fold_column, (key % k).cast("int"))
