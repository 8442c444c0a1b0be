"""Reading and writing files: delimited text, Parquet, JSON, lookup tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as fx
from ..operators.clean import require_columns
from ..operators.sampling import semi_join_ids

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv", "json")

# The columns of the claims file by kind; everything else is a code and stays text.
AMOUNT_COLUMNS = ["AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS", "AMT_COPAY", "AMT_PREPAID", "QTY", "UTILS", "CLIENT_LOS"]
KEY_COLUMNS = [
    "CLAIM_ID_KEY", "CS_CLAIM_ID_KEY", "SERVICES_KEY", "IMPUTED_SERVICE_KEY", "SERV_PROV_CW_KEY", "BILL_PROV_CW_KEY", "SV_LINE",
    "FROM_YEAR", "ADM_YR", "DIS_YR",
]


# Texts that stand for a missing value.
NA_TOKENS = ("", "NA", "N/A", "n/a", "#N/A", "<NA>", "NULL", "null", "NaN", "nan", "-NaN", "-nan", "None")


def typed(df: DataFrame, schema: T.StructType, na_values: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Text columns in the types of the schema. Missing-value texts become null; a field that does not parse raises."""

    def parsed(field: T.StructField) -> Column:
        text = fx.quoted(field.name)
        missing = text.isNull() | text.isin(list(na_values))
        if isinstance(field.dataType, T.StringType):
            return F.when(~missing, text)
        value = text.try_cast(field.dataType)
        problem = F.raise_error(F.concat(F.lit(f"column {field.name}: cannot read as {field.dataType.simpleString()}: "), text))
        return F.when(~missing, F.when(value.isNotNull(), value).otherwise(problem.cast(field.dataType)))

    return df.select(*[parsed(f).alias(f.name) for f in schema.fields])


def claims_schema(header: Sequence[str]) -> T.StructType:
    """Amounts as double, keys and years as bigint, codes as text, in file order."""
    kinds = {c: T.DoubleType() for c in AMOUNT_COLUMNS} | {c: T.LongType() for c in KEY_COLUMNS}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])


def header_of(spark: SparkSession, path: str, sep: str = "|") -> list[str]:
    """Column names from the header line alone."""
    return spark.read.option("sep", sep).option("header", True).option("inferSchema", False).csv(path).columns


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    usecols: Sequence[str] | None = None,
    nrows: int | None = None,
    sep: str = "|",
    na_values: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """A delimited text file with a header. Without a schema all columns are text.

    Missing-value texts (``na_values``) become null; any other field that does not parse as its
    type raises when it is read, and so does a line with too few or too many fields, whichever
    columns are wanted. ``nrows`` stops the scan early.
    """
    # pruning would leave the fields of a line uncounted
    reader = spark.read.option("sep", sep).option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST").option("columnPruning", False)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None:
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        reader = reader.schema(as_text).option("enforceSchema", False)
    df = reader.csv(list(path) if not isinstance(path, str) else path)
    df = typed(df, schema if schema is not None else df.schema, na_values)
    if usecols is not None:
        df = require_columns(df, usecols, "file").select(*[fx.quoted(c) for c in usecols])
    df = fx.nan_to_null(df)
    return df.limit(nrows) if nrows is not None else df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*[fx.quoted(c) for c in columns])
    return fx.nan_to_null(df)


def read_full(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", **options) -> DataFrame:
    """All files as one DataFrame; columns are matched by name."""
    frames = [read_object_store(spark, p, fmt, **options) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_with_filter(df: DataFrame, column: str, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose value is in the set. Nothing matching gives no rows.

    A list becomes an IN predicate in the scan; a DataFrame of values becomes a semi join.
    """
    require_columns(df, [column])
    return semi_join_ids(df, column, values)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_object_store(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write to any Spark path (``s3a://...`` or a mounted folder) as parquet, csv or json lines."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)


def read_object_store(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Any Spark path. Text that does not fit the schema raises, unless ``mode`` says otherwise."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    reader = spark.read.options(**({"mode": "FAILFAST"} if fmt != "parquet" else {}) | options)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return fx.nan_to_null(reader.format(fmt).load(path))


# --- lookups ------------------------------------------------------------------------------


def read_lookup(spark: SparkSession, path: str, sep: str = "|", infer: bool = False) -> DataFrame:
    """A small code table. Codes stay text, so 01 and 1 or 0100 and 100 remain apart.

    ``infer=True`` guesses types instead. A missing file raises FileNotFoundError.
    """
    try:
        return spark.read.option("sep", sep).option("header", True).option("inferSchema", infer).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"lookup table not found: {path}") from error
        raise


def list_files(spark: SparkSession, folder: str, suffix: str = ".txt") -> list[str]:
    """Names in a folder of any Hadoop file system: a folder listing, no data."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(s.getPath().toString() for s in where.getFileSystem(conf).listStatus(where) if s.getPath().getName().endswith(suffix))


def read_all_lookups(spark: SparkSession, folder: str, sep: str = "|", register: bool = False) -> Mapping[str, DataFrame]:
    """Every ``*.txt`` in the folder by its stem; a file that cannot be read is logged and skipped."""
    tables = {}
    for path in list_files(spark, folder):
        name = path.rsplit("/", 1)[-1].removesuffix(".txt")
        try:
            tables[name] = read_lookup(spark, path, sep)
            if register:
                tables[name].createOrReplaceTempView(name)
        except Exception as error:
            log.warning("failed to load %s: %s", name, error)
    return tables


def enrich_lookup(df: DataFrame, lookup: DataFrame, on: str, lookup_key: str | None = None) -> DataFrame:
    """Left join a lookup; repeated lookup keys are reduced to their smallest row first."""
    key = lookup_key or lookup.columns[0]
    others = [c for c in lookup.columns if c != key]
    one = lookup.groupBy(fx.quoted(key).alias("__code")).agg(F.min(F.struct(*[fx.quoted(c) for c in others])).alias("__row"))
    joined = df.join(one, fx.quoted(on) == F.col("__code"), "left")
    taken = [F.col("__row").getField(c).alias(c if c not in df.columns else f"{c}_lookup") for c in others]
    return joined.select(*[fx.quoted(c) for c in df.columns], *taken)
