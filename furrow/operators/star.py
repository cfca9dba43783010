"""Split of harmonised rows into a dimension and a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import scalars as X
from furrow.operators.merge import DIM_KEY

DIM_INSERT_ONLY = ["commodity_group", "grade", "source_url", "source_name", "method"]
DIM_REFRESHED = ["market_id", "commodity_alias_lookup_id"]
PRICES = ["min_price", "max_price", "modal_price"]
MEASURES = ["arrival_quantity", *PRICES]


def with_key(rows: DataFrame, key: list[str] | None = None, name: str = "market_commodity_id") -> DataFrame:
    """The surrogate key: a hash of the natural key, so facts need no lookup of ids."""
    return rows.withColumn(name, X.surrogate_key(*(F.col(c) for c in key or DIM_KEY)))


def last_of_day(rows: DataFrame) -> DataFrame:
    """Of each key and date the last row by ordinal: one shuffle of harmonised rows, which both tables of split() then read."""
    others = [c for c in rows.columns if c not in (*DIM_KEY, "date")]
    last = rows.groupBy(*DIM_KEY, "date").agg(F.max_by(F.struct(*others), "ordinal").alias("_last"))
    return last.select(*DIM_KEY, "date", "_last.*")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dimension rows, fact rows). Facts without a date or without any price are left out; their dimension row stays."""
    keyed = with_key(rows)
    dim = keyed.select("market_commodity_id", *DIM_KEY, *DIM_INSERT_ONLY, *DIM_REFRESHED, "ordinal")
    # one condition, so that no half of it is pushed below an aggregation that both tables could share
    fact = keyed.where(F.when(F.col("date").isNotNull(), F.coalesce(*(F.col(c) for c in PRICES))).isNotNull())
    return dim, fact.select("market_commodity_id", "date", *DIM_REFRESHED, *MEASURES, "ordinal")


def attach_ids(fact: DataFrame, dim: DataFrame, key: list[str], ident: str) -> DataFrame:
    """Facts with their dimension's id by the null-safe natural key."""
    right = dim.select(F.col(ident), *(F.col(k).alias(f"_{k}") for k in key))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return fact.join(right, on, "left").drop(*(f"_{k}" for k in key))


def without_nulls(rows: DataFrame) -> DataFrame:
    """Rows as JSON documents without their null fields."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("document"))
