"""The driver's star-schema tables seen as claim lines.

``claims_view`` joins only the tables that the requested columns need. That is sound because
each joined table is keyed by the join column and joined with a left join, so a join that adds
no requested column adds and removes no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# column -> (SQL expression, table it needs beyond lineitem)
CLAIM_COLUMNS = {
    "CLAIM_ID_KEY": ("l_orderkey", None),
    "SV_LINE": ("l_linenumber", None),
    "AMT_BILLED": ("l_extendedprice", None),
    "AMT_PAID": ("l_extendedprice * (1 - l_discount) - 2000", None),
    "AMT_DEDUCT": ("l_extendedprice * l_discount", None),
    "AMT_COINS": ("l_extendedprice * l_tax", None),
    "AGE": ("CASE WHEN p_size >= 45 THEN '90+' ELSE CAST(p_size + 20 AS {text}) END", "part"),
    "SEX": ("CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END", "orders"),
    "FORM_TYPE": ("l_linestatus", None),
    "SV_STAT": ("l_returnflag", None),
    "PRODUCT_TYPE": ("c_mktsegment", "customer"),
    "ICD_DIAG_01_PRIMARY": (
        "CASE l_partkey % 10 WHEN 0 THEN 'W01' WHEN 1 THEN 'X02' WHEN 2 THEN 'Y03' WHEN 3 THEN 'B20' "
        "WHEN 4 THEN 'A15' WHEN 5 THEN 'n18' WHEN 6 THEN 'Z00' WHEN 7 THEN '401' WHEN 8 THEN 'M54' END",
        None,
    ),
    "ICD_DIAG_02": ("CASE WHEN l_suppkey % 3 = 0 THEN 'E11' END", None),
    "PROC_CODE": ("CAST(90000 + l_partkey AS {text})", None),
    "CLIENT_LOS": ("CASE WHEN l_quantity < 5 THEN NULL ELSE l_linenumber - 1 END", None),
}

AMOUNTS = ["AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims_view(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(CLAIM_COLUMNS if columns is None else columns)
    needed = {CLAIM_COLUMNS[c][1] for c in names}
    lines = table(spark, sf_dir, "lineitem")
    if needed & {"orders", "customer"}:
        lines = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "customer" in needed:
        lines = lines.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if "part" in needed:
        lines = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return lines.selectExpr(*[f"{CLAIM_COLUMNS[c][0].format(text='string')} AS {c}" for c in names])


def claims_sql(columns: Sequence[str] | None = None) -> str:
    """The same view as one SELECT, for the oracle."""
    names = list(CLAIM_COLUMNS if columns is None else columns)
    picked = ", ".join(f"{CLAIM_COLUMNS[c][0].format(text='VARCHAR')} AS {c}" for c in names)
    return (
        f"SELECT {picked} FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey "
        "LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey"
    )
