"""Sources and sinks, projections, filters, joins, sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import clean, sampling
from ..operators.quality import anti_invalid_values
from ..plans import claims as plans
from ..plans import workflows
from ..plans.claims_view import AMOUNTS, claims_view, table
from ..session import scratch_path
from ..sources import files, warehouse
from ..streaming.ingest import scan_partitions
from .registry import Catalog, key_sql, over_claims

catalog = Catalog()
add = catalog.add

LINE = ["CLAIM_ID_KEY", "SV_LINE"]
FLAT = [*LINE, "AMT_BILLED", "AMT_PAID", "SV_STAT", "ICD_DIAG_01_PRIMARY", "CLIENT_LOS"]
FLAT_SQL = (
    "SELECT CLAIM_ID_KEY, CAST(SV_LINE AS BIGINT) AS SV_LINE, AMT_BILLED, AMT_PAID, SV_STAT, ICD_DIAG_01_PRIMARY, "
    "CAST(CLIENT_LOS AS DOUBLE) AS CLIENT_LOS FROM claims"
)


def stored_claims(spark, sf_dir, sep="|"):
    """The claims as delimited text files in the shared folder."""
    path = scratch_path(spark, "claims-text")
    files.write_csv(claims_view(spark, sf_dir, FLAT), path, sep)
    return path


# --- sources and sinks --------------------------------------------------------------------


@add("read_delimited", over_claims(FLAT_SQL, FLAT))
def read_delimited(spark, sf_dir):
    return files.read_delimited(spark, stored_claims(spark, sf_dir), files.claims_schema(FLAT), FLAT)


@add("read_parquet", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def read_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_extendedprice"])


@add("write_csv", over_claims(FLAT_SQL, FLAT))
def write_csv(spark, sf_dir):
    return files.read_delimited(spark, stored_claims(spark, sf_dir, ","), files.claims_schema(FLAT), sep=",")


@add("write_parquet", over_claims("SELECT * FROM claims", FLAT))
def write_parquet(spark, sf_dir):
    path = scratch_path(spark, "claims-parquet")
    files.write_parquet(claims_view(spark, sf_dir, FLAT), path, "zstd")
    return files.read_parquet(spark, path)


FEW = f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({FLAT_SQL}) WHERE CLAIM_ID_KEY % 50 NOT IN (3, 7, 11)"
NO_FIELDS = "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)"


@add(
    "scan_partitions",
    over_claims(
        FEW + " UNION ALL SELECT CLAIM_ID_KEY, CAST(SV_LINE AS BIGINT), AMT_BILLED, CAST(NULL AS DOUBLE), SV_STAT, ICD_DIAG_01_PRIMARY, CAST(CLIENT_LOS AS DOUBLE), "
        f"CAST(NULL AS VARCHAR) FROM claims WHERE CLAIM_ID_KEY % 50 = 3 UNION ALL SELECT {NO_FIELDS}, 'wrong number of fields' FROM claims WHERE CLAIM_ID_KEY % 50 = 7 "
        f"UNION ALL SELECT {NO_FIELDS}, 'bad value: AMT_PAID' FROM claims WHERE CLAIM_ID_KEY % 50 = 11",
        FLAT,
    ),
)
def scan(spark, sf_dir):
    """Arriving text: some amounts missing, some lines cut short, some amounts no numbers. Good and bad rows together."""
    paid = F.expr("CASE CLAIM_ID_KEY % 50 WHEN 3 THEN 'NA' WHEN 11 THEN 'much' ELSE string(AMT_PAID) END")
    rows = claims_view(spark, sf_dir, FLAT).withColumn("AMT_PAID", paid)
    fields = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FLAT])
    landing, output, rejected, state = (scratch_path(spark, f"ingest-{n}") for n in ("landing", "output", "rejected", "state"))
    rows.select(F.when(F.col("CLAIM_ID_KEY") % 50 == 7, F.substring_index(fields, "|", 3)).otherwise(fields).alias("value")).write.text(landing)
    schema = files.claims_schema(FLAT)
    for _ in range(2):  # the second run finds nothing new
        scan_partitions(spark, landing, output, state, schema, "csv", 4, rejected, "|")
    good, bad = spark.read.parquet(output).drop("batch"), spark.read.parquet(rejected)
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad.select("error"), allowMissingColumns=True)


@add("read_full", "SELECT * FROM orders")
def read_full(spark, sf_dir):
    orders, paths = table(spark, sf_dir, "orders"), []
    for status in ("F", "O", "P"):
        paths.append(scratch_path(spark, f"orders-{status}"))
        files.write_parquet(orders.filter(F.col("o_orderstatus") == status), paths[-1])
    return files.read_full(spark, paths)


@add("read_with_filter", over_claims("SELECT * FROM claims WHERE SV_STAT IN ('A', 'R')", [*LINE, "SV_STAT", "AMT_PAID"]))
def read_with_filter(spark, sf_dir):
    return files.read_with_filter(claims_view(spark, sf_dir, [*LINE, "SV_STAT", "AMT_PAID"]), "SV_STAT", ["A", "R"])


@add("read_lookup", "SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, p_name AS description, p_brand AS brand FROM part")
def read_lookup(spark, sf_dir):
    path = scratch_path(spark, "REF_PART")
    rows = table(spark, sf_dir, "part").selectExpr(
        "lpad(CAST(p_partkey AS string), 8, '0') AS code", "p_name AS description", "p_brand AS brand"
    )
    files.write_csv(rows, path, "|")
    return files.read_lookup(spark, path)


@add(
    "read_all_lookups",
    "SELECT 'REF_PART' AS lookup, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, p_name AS description FROM part "
    "UNION ALL SELECT 'REF_SUPPLIER', lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), s_name FROM supplier "
    "UNION ALL SELECT 'REF_NATION', lpad(CAST(n_nationkey AS VARCHAR), 8, '0'), n_name FROM nation",
)
def read_all_lookups(spark, sf_dir):
    folder = scratch_path(spark, "lookups")
    for name, key, text in (("part", "p_partkey", "p_name"), ("supplier", "s_suppkey", "s_name"), ("nation", "n_nationkey", "n_name")):
        rows = table(spark, sf_dir, name).selectExpr(f"lpad(CAST({key} AS string), 8, '0') AS code", f"{text} AS description")
        files.write_csv(rows, f"{folder}/REF_{name.upper()}.txt", "|")
    tables = files.read_all_lookups(spark, folder)
    return warehouse.union_all([df.select(F.lit(name).alias("lookup"), "code", "description") for name, df in tables.items()])


@add("write_object_store", over_claims("SELECT * FROM claims", FLAT))
def write_object_store(spark, sf_dir):
    path, claims = scratch_path(spark, "claims-json"), claims_view(spark, sf_dir, FLAT)
    files.write_object_store(claims, path, "json")
    return files.read_object_store(spark, path, "json", claims.schema)


@add("read_object_store", over_claims("SELECT * FROM claims", FLAT))
def read_object_store(spark, sf_dir):
    path, claims = scratch_path(spark, "claims-csv"), claims_view(spark, sf_dir, FLAT)
    files.write_object_store(claims, path, "csv")
    return files.read_object_store(spark, path, "csv", claims.schema)


@add("create_table", "SELECT o_orderkey AS claim_id, o_orderstatus AS status, o_totalprice AS amount FROM orders")
def create_table(spark, sf_dir):
    name = f"claims_{uuid.uuid4().hex}"
    warehouse.create_table(
        spark, name, "claim_id bigint, status string, amount double", ["claim_id"], "claim_id", scratch_path(spark, "warehouse")
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS claim_id", "o_orderstatus AS status", "o_totalprice AS amount")
    orders.sortWithinPartitions("claim_id").write.insertInto(name)
    return spark.table(name)


STAGED = {
    "claim_id": "l_orderkey",
    "service_date": "CAST(l_shipdate AS DATE)",
    "form_type": "l_linestatus",
    "sv_stat": "l_returnflag",
    "amt_billed": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "amt_deduct": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2))",
    "client_los": "l_linenumber",
}
LOADED = (
    "claim_id, CAST(service_date AS {text}) AS service_date, form_type, sv_stat, CAST(amt_billed AS DOUBLE) AS amt_billed, "
    "CAST(amt_deduct AS DOUBLE) AS amt_deduct, client_los, created_at IS NOT NULL AS stamped"
)


@add(
    "copy_into",
    f"WITH staged AS (SELECT {', '.join(f'{v} AS {k}' for k, v in STAGED.items())}, TIMESTAMP '2020-01-01' AS created_at "
    f"FROM lineitem) SELECT {LOADED.format(text='VARCHAR')} FROM staged",
)
def copy_into(spark, sf_dir):
    path, name = scratch_path(spark, "staged"), f"claims_{uuid.uuid4().hex}"
    files.write_object_store(table(spark, sf_dir, "lineitem").selectExpr(*[f"{v} AS {k}" for k, v in STAGED.items()]), path, "parquet")
    warehouse.create_table(spark, name, warehouse.CLAIMS_TABLE, ["claim_id"], None, scratch_path(spark, "warehouse"))
    warehouse.copy_into(spark, name, path)
    return spark.sql(f"SELECT {LOADED.format(text='string')} FROM {name}")


PAID_BY_LINE = (
    "SELECT CLAIM_ID_KEY, count(*) AS n_lines, round(sum(AMT_BILLED), 4) AS billed, round(sum(AMT_PAID), 4) AS paid "
    "FROM {claims} GROUP BY CLAIM_ID_KEY"
)


@add("unload_query", over_claims(PAID_BY_LINE.format(claims="claims"), ["CLAIM_ID_KEY", "AMT_BILLED", "AMT_PAID"]))
def unload_query(spark, sf_dir):
    path = scratch_path(spark, "unloaded")
    claims = claims_view(spark, sf_dir, ["CLAIM_ID_KEY", "AMT_BILLED", "AMT_PAID"])
    warehouse.unload_query(spark, PAID_BY_LINE, path, tables={"claims": claims})
    return spark.read.parquet(path)


BY_STATUS = (
    "SELECT SV_STAT, FORM_TYPE, count(*) AS n, round(avg(AMT_PAID), 4) AS mean_paid FROM {claims} "
    "WHERE AMT_PAID >= 0 GROUP BY SV_STAT, FORM_TYPE"
)


@add("run_sql", over_claims(BY_STATUS.format(claims="claims"), ["SV_STAT", "FORM_TYPE", "AMT_PAID"]))
def run_sql(spark, sf_dir):
    return warehouse.run_sql(spark, BY_STATUS, {"claims": claims_view(spark, sf_dir, ["SV_STAT", "FORM_TYPE", "AMT_PAID"])})


@add(
    "catalog_files",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS o_totalprice FROM orders",
)
def catalog_files(spark, sf_dir):
    folder, stem = scratch_path(spark, "landing"), uuid.uuid4().hex
    orders = table(spark, sf_dir, "orders")
    files.write_parquet(orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey"), folder)
    warehouse.catalog_files(spark, {stem: folder})
    files.write_parquet(orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", "o_totalprice"), folder, mode="append")
    names = warehouse.catalog_files(spark, {stem: folder})
    return spark.table(names[0])


@add(
    "etl_min_clean",
    over_claims("SELECT * FROM claims WHERE AMT_PAID >= 0 AND AMT_BILLED >= 0", [*LINE, "AMT_PAID", "AMT_BILLED", "SV_STAT"]),
)
def etl_min_clean(spark, sf_dir):
    path = scratch_path(spark, "etl")
    files.write_parquet(plans.etl_min_clean(claims_view(spark, sf_dir, [*LINE, "AMT_PAID", "AMT_BILLED", "SV_STAT"])), path)
    return files.read_parquet(spark, path)


# --- projections and filters --------------------------------------------------------------


@add("drop_columns", over_claims("SELECT * EXCLUDE (PROC_CODE, ICD_DIAG_02) FROM claims"))
def drop_columns(spark, sf_dir):
    return clean.drop_columns(claims_view(spark, sf_dir), ["PROC_CODE", "ICD_DIAG_02", "NOT_THERE"])


@add("drop_high_missing", over_claims("SELECT CLAIM_ID_KEY, SV_LINE, ICD_DIAG_01_PRIMARY, CLIENT_LOS FROM claims"))
def drop_high_missing(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*LINE, "ICD_DIAG_01_PRIMARY", "ICD_DIAG_02", "CLIENT_LOS"])
    return clean.drop_high_missing(df, table(spark, sf_dir, "lineitem").count() // 2, ["CLIENT_LOS"])[0]


@add(
    "fill_missing",
    over_claims(
        "SELECT CLAIM_ID_KEY, SV_LINE, coalesce(CLIENT_LOS, 0) AS CLIENT_LOS, coalesce(ICD_DIAG_02, 'none') AS ICD_DIAG_02 FROM claims"
    ),
)
def fill_missing(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*LINE, "CLIENT_LOS", "ICD_DIAG_02"])
    return clean.fill_missing(df, {"CLIENT_LOS": 0, "ICD_DIAG_02": "none", "NOT_THERE": 1})


NULLABLE = [*LINE, "SEX", "ICD_DIAG_01_PRIMARY", "CLIENT_LOS"]


@add(
    "drop_missing_rows",
    over_claims(
        "SELECT * FROM claims WHERE SEX IS NOT NULL AND ICD_DIAG_01_PRIMARY IS NOT NULL AND CLIENT_LOS IS NOT NULL", NULLABLE
    ),
)
def drop_missing_rows(spark, sf_dir):
    return clean.drop_missing_rows(claims_view(spark, sf_dir, NULLABLE))


@add("filter_non_negative", over_claims("SELECT * FROM claims WHERE AMT_PAID >= 0 AND CLIENT_LOS >= 0", [*LINE, "AMT_PAID", "CLIENT_LOS"]))
def filter_non_negative(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*LINE, "AMT_PAID", "CLIENT_LOS"])
    return clean.filter_non_negative(df, ["AMT_PAID", "CLIENT_LOS", "NOT_THERE"])


@add("split_features_target", over_claims("SELECT CLAIM_ID_KEY, AMT_BILLED, SV_STAT FROM claims"))
def split_features_target(spark, sf_dir):
    return clean.split_features_target(claims_view(spark, sf_dir, ["CLAIM_ID_KEY", "AMT_BILLED", "SV_STAT", "AMT_PAID"]), "AMT_PAID")[0]


@add("require_columns", over_claims("SELECT * FROM claims", AMOUNTS))
def require_columns(spark, sf_dir):
    return clean.require_columns(claims_view(spark, sf_dir, AMOUNTS), ["AMT_BILLED", "AMT_PAID"], "Claims")


@add(
    "safe_divide",
    over_claims(
        "SELECT CLAIM_ID_KEY, SV_LINE, CASE WHEN AMT_DEDUCT = 0 THEN -1.0 ELSE AMT_PAID / nullif(AMT_DEDUCT, 0) END AS ratio FROM claims"
    ),
)
def safe_divide(spark, sf_dir):
    df = claims_view(spark, sf_dir, [*LINE, "AMT_PAID", "AMT_DEDUCT"])
    return df.select(*LINE, fx.safe_divide(F.col("AMT_PAID"), F.col("AMT_DEDUCT"), -1.0).alias("ratio"))


# --- joins --------------------------------------------------------------------------------


@add(
    "semi_join_ids",
    over_claims(
        "SELECT * FROM claims WHERE CLAIM_ID_KEY IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey "
        "WHERE c_acctbal < 0)",
        [*LINE, "AMT_PAID"],
    ),
)
def semi_join_ids(spark, sf_dir):
    owing = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    ids = table(spark, sf_dir, "orders").join(owing, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    return sampling.semi_join_ids(claims_view(spark, sf_dir, [*LINE, "AMT_PAID"]), "CLAIM_ID_KEY", ids)


@add(
    "anti_invalid_values",
    over_claims(
        "SELECT DISTINCT PROC_CODE AS value FROM claims WHERE PROC_CODE IS NOT NULL AND PROC_CODE NOT IN "
        "(SELECT CAST(90000 + p_partkey AS VARCHAR) FROM part WHERE p_size > 3)",
        ["PROC_CODE"],
    ),
)
def anti_invalid(spark, sf_dir):
    valid = table(spark, sf_dir, "part").filter("p_size > 3").selectExpr("CAST(90000 + p_partkey AS string) AS code")
    return anti_invalid_values(claims_view(spark, sf_dir, ["PROC_CODE"]), "PROC_CODE", valid)


@add(
    "enrich_lookup",
    over_claims(
        ", lookup AS (SELECT CAST(90000 + p_partkey AS VARCHAR) AS code, p_name, p_brand FROM part WHERE p_partkey % 5 <> 0 "
        "UNION ALL SELECT CAST(90000 + p_partkey AS VARCHAR), upper(p_name), p_brand FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 5 <> 0), "
        "one AS (SELECT code, min(p_name) AS p_name, min(p_brand) AS p_brand FROM lookup GROUP BY code) "
        "SELECT CLAIM_ID_KEY, SV_LINE, PROC_CODE, p_name, p_brand FROM claims LEFT JOIN one ON PROC_CODE = code",
        [*LINE, "PROC_CODE"],
    ),
)
def enrich_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0")
    lookup = part.selectExpr("CAST(90000 + p_partkey AS string) AS code", "p_name", "p_brand").unionByName(
        part.filter("p_partkey % 3 = 0").selectExpr("CAST(90000 + p_partkey AS string) AS code", "upper(p_name) AS p_name", "p_brand")
    )
    return files.enrich_lookup(claims_view(spark, sf_dir, [*LINE, "PROC_CODE"]), lookup, "PROC_CODE", "code")


# --- sampling and splitting ---------------------------------------------------------------

SPLIT = [*LINE, "AMT_BILLED", "AMT_PAID", "SV_STAT"]
SPLIT_ORDER = f"{key_sql(LINE)}, CLAIM_ID_KEY, SV_LINE, AMT_BILLED, AMT_PAID, SV_STAT"


@add(
    "sample_by_key",
    over_claims(
        f"SELECT * FROM claims WHERE CLAIM_ID_KEY IN (SELECT id FROM (SELECT DISTINCT CLAIM_ID_KEY AS id FROM claims) "
        f"ORDER BY {key_sql(['id'])}, id LIMIT 5000)",
        SPLIT,
    ),
)
def sample_by_key(spark, sf_dir):
    return sampling.sample_by_key(claims_view(spark, sf_dir, SPLIT), "CLAIM_ID_KEY", 5000)


@add("sample_rows", over_claims(f"SELECT * FROM claims ORDER BY {SPLIT_ORDER} LIMIT 5000", SPLIT))
def sample_rows(spark, sf_dir):
    return sampling.sample_rows(claims_view(spark, sf_dir, SPLIT), 5000, LINE)


@add(
    "train_test_split",
    over_claims(
        f", ranked AS (SELECT *, row_number() OVER (ORDER BY {SPLIT_ORDER}) AS place, count(*) OVER () AS n FROM claims) "
        "SELECT CLAIM_ID_KEY, SV_LINE, AMT_BILLED, AMT_PAID, SV_STAT, "
        "CASE WHEN place <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS side FROM ranked",
        SPLIT,
    ),
)
def train_test_split(spark, sf_dir):
    train, test = sampling.train_test_split(claims_view(spark, sf_dir, SPLIT), 0.2, LINE)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@add(
    "stratified_split",
    over_claims(
        f", ranked AS (SELECT *, row_number() OVER (PARTITION BY SV_STAT ORDER BY {SPLIT_ORDER}) AS place FROM claims), "
        "totals AS (SELECT SV_STAT AS stratum, count(*) AS total FROM claims GROUP BY SV_STAT), "
        "asked AS (SELECT *, CAST(ceil(sum(total) OVER () * CAST(0.25 AS DOUBLE)) AS BIGINT) AS asked, "
        "CAST(sum(total) OVER () AS BIGINT) AS n FROM totals), "
        "ideal AS (SELECT *, CAST(total AS DOUBLE) * CAST(asked AS DOUBLE) / CAST(n AS DOUBLE) AS ideal FROM asked), "
        "placed AS (SELECT *, floor(ideal) AS whole, row_number() OVER (ORDER BY ideal - floor(ideal) DESC, stratum) AS place_r FROM ideal), "
        "quotas AS (SELECT stratum, whole + CASE WHEN place_r <= asked - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM placed) "
        "SELECT CLAIM_ID_KEY, SV_LINE, AMT_BILLED, AMT_PAID, SV_STAT, place <= quota AS is_test "
        "FROM ranked JOIN quotas ON SV_STAT = stratum",
        SPLIT,
    ),
)
def stratified_split(spark, sf_dir):
    return sampling.tag_test_rows(claims_view(spark, sf_dir, SPLIT), 0.25, LINE, "SV_STAT")


@add("k_folds", over_claims(f"SELECT CLAIM_ID_KEY, SV_LINE, CAST({key_sql(LINE)} % 5 AS INTEGER) AS fold FROM claims", LINE))
def k_folds(spark, sf_dir):
    return sampling.k_folds(claims_view(spark, sf_dir, LINE), 5, LINE)


# --- the ingest workflow ------------------------------------------------------------------

ARRIVING = [*LINE, "AMT_BILLED", "AMT_PAID", "AMT_DEDUCT", "AMT_COINS", "PROC_CODE", "CLIENT_LOS"]
ENRICHED = [*ARRIVING, "p_name", "p_brand"]


@add(
    "ingest_workflow",
    over_claims(
        f", ids AS (SELECT id FROM (SELECT DISTINCT CLAIM_ID_KEY AS id FROM claims) ORDER BY {key_sql(['id'])}, id LIMIT 5000), "
        "s AS (SELECT claims.*, p_name, p_brand FROM claims LEFT JOIN (SELECT * FROM part WHERE p_partkey % 5 <> 0) ON PROC_CODE = CAST(90000 + p_partkey AS VARCHAR) "
        "WHERE CLAIM_ID_KEY IN (SELECT id FROM ids)) "
        f"SELECT count(*) AS rows, {len(ENRICHED)} AS columns, " + " + ".join(f"CAST(count({c}) < count(*) AS INTEGER)" for c in ENRICHED) + " AS columns_with_nulls, "
        "round(avg(AMT_PAID), 4) AS mean, count(DISTINCT CLAIM_ID_KEY) AS claims, count(p_brand) AS described, "
        "bool_and(AMT_BILLED >= 0 AND AMT_PAID >= 0 AND AMT_DEDUCT >= 0 AND AMT_COINS >= 0) AS no_negatives, count(*) - count(CLIENT_LOS) AS los_missing FROM s",
        ARRIVING,
    ),
)
def ingest_workflow(spark, sf_dir):
    """Sample whole claims, describe their codes, store, validate and profile; what the workflow reports."""
    parts = table(spark, sf_dir, "part").filter("p_partkey % 5 <> 0").selectExpr("CAST(90000 + p_partkey AS string) AS code", "p_name", "p_brand")
    claims = claims_view(spark, sf_dir, ARRIVING)
    done = workflows.ingest(spark, claims, {"PROC_CODE": parts}, scratch_path(spark, "ingested"), n_ids=5000)
    negatives = done.checks.where("check_name LIKE '%Negative%'").first()["passed"]
    missing = done.missing.where("column = 'CLIENT_LOS'").first()["missing_count"]
    seen = done.sample.agg(F.countDistinct("CLAIM_ID_KEY").alias("claims"), F.count("p_brand").alias("described")).first()
    counts = {c: F.lit(v).cast("bigint") for c, v in {**seen.asDict(), "los_missing": missing}.items()}
    return done.summary.withColumns({"mean": F.round("mean", 4), "no_negatives": F.lit(negatives), **counts})
