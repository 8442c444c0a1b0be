"""Every registered query at the smallest scale against its SQL in DuckDB."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Two hundred rounds one after another take minutes; they run in the oracle check, and tests/test_models.py fits fewer.
SLOW = {"train_gbt", "train_adaboost", "train_all"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def bag(table):
    def shown(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0 if isinstance(v, float) else v)
    names = sorted(table.column_names)
    return names, Counter(tuple(map(shown, row)) for row in zip(*[table.column(n).to_pylist() for n in names]))


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in SLOW])
def test_query(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir).toArrow()
    if name in ORACLES:
        assert bag(got) == bag(duck.sql(ORACLES[name]).to_arrow_table())
    else:
        assert got.num_rows > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["SV_STAT", "n", "mean_paid"] and entry.entry(spark).count() == 3
