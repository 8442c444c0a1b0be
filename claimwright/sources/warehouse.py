"""Catalog tables: create, bulk load, unload, query, register files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as fx
from .files import read_object_store, write_object_store

# The two warehouse tables.
CLAIMS_TABLE = (
    "claim_id bigint, service_date date, member_age int, gender_code int, form_type string, sv_stat string, "
    "product_type string, icd_category string, amt_billed decimal(12,2), amt_paid decimal(12,2), "
    "amt_deduct decimal(12,2), amt_coins decimal(12,2), client_los int, num_diagnoses int, created_at timestamp"
)
PREDICTIONS_TABLE = (
    "prediction_id bigint, claim_id bigint, predicted_amount decimal(12,2), actual_amount decimal(12,2), "
    "model_version string, prediction_date timestamp"
)

# Columns that default to the time of loading.
LOAD_TIME_COLUMNS = ["created_at", "prediction_date"]


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    sort_keys: Sequence[str] = (),
    primary_key: str | None = None,
    location: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS``. Sort and primary keys are kept as table properties.

    ``copy_into`` sorts files by the sort keys, which gives their Parquet statistics the
    narrow ranges that let scans skip; uniqueness is checked by ``check_unique_values``.
    """
    properties = {"sort_keys": ",".join(sort_keys), "primary_key": primary_key or ""}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet TBLPROPERTIES ({listed}){where}")


def _properties(spark: SparkSession, name: str) -> Mapping[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, cast to the table's types; absent ones are null or the load time."""
    def value(f: T.StructField):
        if f.name in df.columns:
            return fx.quoted(f.name).cast(f.dataType).alias(f.name)
        if f.name in LOAD_TIME_COLUMNS:
            return F.current_timestamp().alias(f.name)
        return F.lit(None).cast(f.dataType).alias(f.name)
    return df.select(*[value(f) for f in schema.fields])


def copy_into(spark: SparkSession, name: str, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> None:
    """Append the files under ``path`` to a table. A failure raises."""
    rows = conform(read_object_store(spark, path, fmt, schema), spark.table(name).schema)
    keys = [k for k in _properties(spark, name).get("sort_keys", "").split(",") if k]
    if keys:
        rows = rows.sortWithinPartitions(*keys)
    rows.write.insertInto(name)


def unload_query(
    spark: SparkSession,
    query: str,
    path: str,
    fmt: str = "parquet",
    parallel: bool = True,
    tables: Mapping[str, DataFrame] | None = None,
) -> None:
    """Write a query's result. ``parallel=False`` asks for a single file, for small results only."""
    result = run_sql(spark, query, tables)
    write_object_store(result if parallel else result.repartition(1), path, fmt)


def run_sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A SQL query; ``tables`` are bound by name for this query only, as ``{name}`` in the text."""
    return spark.sql(query, **(tables or {}))


def read_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """The same against an external warehouse; ``partitionColumn`` and bounds make it parallel."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q").options(**options).load()


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Known columns keep their place and type; unseen ones are added at the end."""
    known = {f.name for f in old.fields}
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


def catalog_files(spark: SparkSession, folders: Mapping[str, str], fmt: str = "parquet", prefix: str = "claims_") -> list[str]:
    """Register each folder as an external table, schema inferred from its files.

    Running it again updates the schema in place: the table is a pointer, the files stay.
    """
    names = []
    for stem, path in folders.items():
        name = f"{prefix}{stem}"
        reader = spark.read.option("mergeSchema", True)
        if fmt == "csv":
            reader = reader.option("header", True).option("inferSchema", True)
        schema = reader.format(fmt).load(path).schema
        if spark.catalog.tableExists(name):
            schema = merged_schema(spark.table(name).schema, schema)
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=path, source=fmt, schema=schema)
        names.append(name)
    return names


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
