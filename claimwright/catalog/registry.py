"""Named queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import KEY_MODULUS
from ..plans.claims_view import claims_sql

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if oracle is not None:
                self.oracles[name] = oracle
            return query

        return register


def over_claims(sql: str, columns: Sequence[str] | None = None) -> str:
    """``sql`` with a CTE ``claims``; further CTEs may follow as ``, name AS (...) SELECT``."""
    return f"WITH claims AS ({claims_sql(columns)}) {sql}"


def key_sql(columns: Sequence[str], seed: int = 42) -> str:
    """The seeded row key of non-negative integer columns, in SQL."""
    key = f"CAST({seed % KEY_MODULUS} AS BIGINT)"
    for c in columns:
        part = f"coalesce(CAST({c} AS BIGINT) % {KEY_MODULUS}, {KEY_MODULUS - 1})"
        step = f"((({key} + {part} + 12345) * 1103515245) % {KEY_MODULUS})"
        key = f"((xor({step}, {step} >> 15) * 16807) % {KEY_MODULUS})"
    return key
