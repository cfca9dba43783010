"""All queries of the engine and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from furrow.plans import audit_queries, mutation_queries, resolve_queries, scalar_queries, source_queries

Query = Callable[[SparkSession, str], DataFrame]
_PARTS = (scalar_queries, audit_queries, resolve_queries, mutation_queries, source_queries)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_queries.price_logic(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {name: q for part in _PARTS for name, (q, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
