"""One keyed merge for all tables: a policy for each column says how old and new values meet."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: insert_only: as first written. overwrite_even_null: the batch's value. overwrite: the batch's value unless null.
#: coalesce_old: the old value unless null. increment: sum of both. set_union: distinct values of both, sorted.
POLICIES = ("insert_only", "overwrite", "overwrite_even_null", "coalesce_old", "increment", "set_union")


def fold_batch(batch: DataFrame, key: list[str], policies: dict[str, str], order: str = "ordinal") -> DataFrame:
    """One row for each key of a batch: first values, last values, sums and unions by order, in one aggregation."""
    spec = []
    for c, p in policies.items():
        if p == "insert_only":
            spec.append(F.min_by(c, order).alias(c))
        elif p == "overwrite_even_null":
            spec.append(F.max_by(c, order).alias(c))
        elif p in ("overwrite", "coalesce_old"):
            spec.append((F.max_by if p == "overwrite" else F.min_by)(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c))
        elif p == "increment":
            spec.append(F.sum(c).alias(c))
        elif p == "set_union":
            spec.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c))
        else:
            raise ValueError(f"unknown policy {p}")
    return batch.groupBy(*key).agg(*spec)


def merge(old: DataFrame, batch: DataFrame, key: list[str], policies: dict[str, str], order: str = "ordinal") -> DataFrame:
    """The new state of old after batch. Keys match null-safely; a batch merged twice changes only what increments."""
    new = fold_batch(batch, key, policies, order).withColumn("_new", F.lit(True))
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.alias("n")
    both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key], "full")
    was, now = F.col("o._old").isNotNull(), F.col("n._new").isNotNull()

    def value(c: str, p: str) -> Column:
        a, b = F.col(f"o.{c}"), F.col(f"n.{c}")
        if p == "insert_only":
            return F.when(was, a).otherwise(b)
        if p == "overwrite_even_null":
            return F.when(now, b).otherwise(a)
        if p == "overwrite":
            return F.coalesce(b, a)
        if p == "coalesce_old":
            return F.coalesce(a, b)
        if p == "increment":
            return F.when(was | now, F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        none = F.array().cast(dict(old.dtypes)[c])
        return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))

    keys = [F.when(was, F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in key]
    action = F.when(was & now, "update").when(now, "insert").otherwise("keep").alias("action")
    return both.select(*keys, *(value(c, p).alias(c) for c, p in policies.items()), action)


def merge_stats(merged: DataFrame) -> DataFrame:
    """Counts of inserted, updated and kept rows of a merge plan."""
    return merged.agg(*(F.count_if(F.col("action") == a).alias(f"{a}_rows") for a in ("insert", "update", "keep")))


def upload_stats(rows: DataFrame, dim: DataFrame, fact: DataFrame) -> DataFrame:
    """The counters of a run: rows without any part of the key, and what the merge plans of dimension and facts insert and update.

    Errors and unresolved combinations can't occur: keys are hashes, and a merge is one table.
    """
    skipped = rows.agg(F.count_if(F.coalesce(*(F.col(c) for c in DIM_KEY)).isNull()).alias("skipped_degenerate"))
    none = [F.lit(0).cast("bigint").alias(c) for c in ("master_errors", "price_errors", "unresolved_combos")]
    counts = [merge_stats(x).select(F.col("insert_rows").alias(f"{n}_upserted"), F.col("update_rows").alias(f"{n}_matched")) for n, x in (("master", dim), ("price", fact))]
    return counts[0].crossJoin(counts[1]).crossJoin(skipped).select("*", *none)  # one row each


DIM_KEY = ["source_system", "state", "market_name", "commodity_name", "variety"]
#: Policies of the tables.
DIM = {"commodity_group": "insert_only", "grade": "insert_only", "source_url": "insert_only", "source_name": "insert_only", "method": "insert_only", "market_id": "overwrite_even_null", "commodity_alias_lookup_id": "overwrite_even_null"}
FACT = dict.fromkeys(["market_id", "commodity_alias_lookup_id", "arrival_quantity", "min_price", "max_price", "modal_price"], "overwrite_even_null")
REVIEW = {"type": "insert_only", "status": "insert_only", "first_seen": "insert_only", "title": "overwrite_even_null", "details": "overwrite_even_null", "last_seen": "overwrite_even_null", "last_run_id": "overwrite_even_null", "state": "overwrite_even_null", "source": "overwrite_even_null", "times_seen": "increment", "records_seen": "increment", "states": "set_union", "sources": "set_union", "sample_markets": "set_union", "sample_commodities": "set_union"}
SUGGESTION = {"type": "insert_only", "status": "insert_only", "first_seen": "insert_only", "title": "insert_only", "details": "insert_only", "last_seen": "overwrite_even_null", "records_seen": "overwrite_even_null", "suggestion": "overwrite_even_null"}
MARKET = {"aliases": "set_union", "district": "overwrite", "postcode": "overwrite", "location": "overwrite", "created_at": "insert_only", "updated_at": "overwrite_even_null"}
IMPORT = {"canonical_name": "insert_only", "crop_master_id": "overwrite", "aliases": "set_union", "source_tags": "insert_only", "confidence": "insert_only", "active": "insert_only", "notes": "overwrite"}
ALIAS = {"crop_master_id": "overwrite", "aliases": "set_union", "source_tags": "set_union", "confidence": "overwrite_even_null", "active": "insert_only", "notes": "overwrite"}


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """df, or an error when some key occurs twice (the unique index of a table)."""
    if not df.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique")
    return df


def save_version(df: DataFrame, table: str, version: int) -> str:
    """Write a new version of a table under a fresh name and move its pointer there; readers see the old or the new, never a part.

    A version whose pointer was never written is dead: the next attempt has a name of its own.
    """
    path = f"v{version}-{uuid4().hex}"
    df.write.parquet(f"{table}/{path}")
    df.sparkSession.createDataFrame([(version, path)], "version int, path string").coalesce(1).write.mode("append").json(f"{table}/_pointer")
    return f"{table}/{path}"


def current_version(spark: SparkSession, table: str) -> tuple[int, str]:
    """Number and path of the newest version; of several of one number (a batch that was run again) the first by name."""
    r = spark.read.schema("version int, path string").json(f"{table}/_pointer").orderBy(F.desc("version"), "path").first()
    return r.version, f"{table}/{r.path}"


def load_current(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, table)[1])
