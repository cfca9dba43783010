"""Queries over audits: counts, duplicates, orphans, freshness, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators import audit as A
from furrow.plans.tables import table

_NOW = "1998-06-01"


def _dirty_customers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).alias("c_name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"), F.col("c_mktsegment"))


def null_scan(spark: SparkSession, d: str) -> DataFrame:
    return A.nulls(_dirty_customers(spark, d), "dim", ["c_name", "c_acctbal", "c_mktsegment"])


NULL_SCAN = """
WITH t AS (SELECT count(*) AS total, count(*) FILTER (c_custkey % 11 = 0) AS a, count(*) FILTER (c_custkey % 3 = 0) AS b FROM customer),
m AS (SELECT 'c_name' AS metric, a AS value, total FROM t UNION ALL SELECT 'c_acctbal', b, total FROM t UNION ALL SELECT 'c_mktsegment', 0, total FROM t)
SELECT 'dim' AS section, metric, value, total, round(100.0::DOUBLE * value / total, 2) AS pct, CASE WHEN value = 0 THEN 'ok' WHEN 10 * value < total THEN 'warn' ELSE 'err' END AS severity FROM m"""


def null_totals(spark: SparkSession, d: str) -> DataFrame:
    """Nulls of all columns of three tables, and of all together."""
    o = table(spark, d, "orders")
    o = o.select(*(F.when(F.col("o_orderkey") % (k + 2) != 0, F.col(c)).alias(c) for k, c in enumerate(o.columns)))
    s = table(spark, d, "supplier")
    found = A.nulls(_dirty_customers(spark, d), "dim", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]).unionByName(A.nulls(o, "fact", o.columns)).unionByName(A.nulls(s, "master", s.columns))
    return A.grand_total(found)


_ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
NULL_TOTALS = f"""
WITH m AS (
  SELECT 'dim' AS section, unnest(['c_custkey', 'c_name', 'c_acctbal', 'c_mktsegment']) AS metric, unnest([0, count(*) FILTER (c_custkey % 11 = 0), count(*) FILTER (c_custkey % 3 = 0), 0]) AS value, count(*) AS total FROM customer
  UNION ALL SELECT 'fact', unnest({_ORDERS}), unnest([{", ".join(f"count(*) FILTER (o_orderkey % {k + 2} = 0)" for k in range(6))}]), count(*) FROM orders
  UNION ALL SELECT 'master', unnest(['s_suppkey', 's_name', 's_nationkey', 's_acctbal']), 0, count(*) FROM supplier),
a AS (SELECT * FROM m UNION ALL SELECT 'all', 'all', sum(value)::BIGINT, sum(total)::BIGINT FROM m)
SELECT *, round(100.0::DOUBLE * value / total, 2) AS pct, CASE WHEN value = 0 THEN 'ok' WHEN 10 * value < total THEN 'warn' ELSE 'err' END AS severity FROM a"""


def quality_holes(spark: SparkSession, d: str) -> DataFrame:
    """Missing names and empty varieties by source."""
    p = table(spark, d, "part").select("p_brand", F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("name"), F.when(F.col("p_partkey") % 5 == 0, F.lit(" ")).when(F.col("p_partkey") % 5 != 1, F.col("p_type")).alias("variety"))
    return A.quality_holes(p, "p_brand", ["name", "variety"], ("variety",))


QUALITY_HOLES = """
SELECT p_brand, unnest(['name_null', 'variety_null', 'variety_empty']) AS metric, unnest([count(*) FILTER (p_partkey % 7 = 0), count(*) FILTER (p_partkey % 5 = 1), count(*) FILTER (p_partkey % 5 = 0)]) AS value, count(*) AS total FROM part GROUP BY p_brand"""


def unmatched_names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.when(F.col("p_partkey") % 9 != 0, F.upper("p_type")).alias("name"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("fk"))
    return A.unmatched_names(p, "name", "fk")


UNMATCHED_NAMES = "SELECT CASE WHEN p_partkey % 9 <> 0 THEN lower(p_type) ELSE '' END AS name, count(*) AS n FROM part WHERE p_partkey % 4 = 0 GROUP BY 1"


def price_logic(spark: SparkSession, d: str) -> DataFrame:
    return A.fused_counts(table(spark, d, "lineitem"), "prices", A.price_logic("l_tax", "l_discount", "l_quantity"))


PRICE_LOGIC = """
WITH t AS (SELECT count(*) AS total, count(*) FILTER (l_tax > l_discount) AS a, count(*) FILTER (l_quantity > l_discount) AS b, count(*) FILTER (l_quantity < l_tax) AS c,
                  count(*) FILTER (l_tax < 0 OR l_discount < 0 OR l_quantity < 0) AS e, count(*) FILTER (l_tax = 0 OR l_discount = 0 OR l_quantity = 0) AS f FROM lineitem)
SELECT 'prices' AS section, metric, value, total FROM (
  SELECT 'min_above_max' AS metric, a AS value, total FROM t UNION ALL SELECT 'modal_above_max', b, total FROM t UNION ALL SELECT 'modal_below_min', c, total FROM t
  UNION ALL SELECT 'negative', e, total FROM t UNION ALL SELECT 'zero', f, total FROM t)"""


def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return A.duplicate_groups(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], "l_linenumber")


DUP_GROUPS = "SELECT l_orderkey, l_partkey, count(*) AS n, min(l_linenumber) AS first_id, max(l_linenumber) AS last_id, count(*) - 1 AS extra FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"


def dup_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of all groups of duplicates; null is a key like any other."""
    x = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("part"), "l_linenumber")
    return A.duplicate_rows(x, ["l_orderkey", "part"], "l_linenumber")


DUP_ROWS = """
SELECT l_orderkey, part, l_linenumber, n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, part) AS n FROM (SELECT l_orderkey, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END AS part, l_linenumber FROM lineitem)) WHERE n > 1"""


def dup_totals(spark: SparkSession, d: str) -> DataFrame:
    return A.duplicate_groups(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"]).agg(F.count("*").alias("groups"), F.coalesce(F.sum("extra"), F.lit(0)).alias("extra_rows"))


DUP_TOTALS = "SELECT count(*) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)"


def _other(key: str, keep: Column) -> Column:
    """key, or another value that no row has where keep isn't true: all rows are there, but some lose their match."""
    return F.when(keep, F.col(key)).otherwise(-1 - F.col(key))


def orphan_dims(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(_other("o_custkey", F.col("o_orderstatus") == "P").alias("o_custkey"))
    return A.childless(table(spark, d, "customer"), o, "c_custkey", "o_custkey").select("c_custkey", "c_name")


ORPHAN_DIMS = "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"


def _most_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(_other("o_orderkey", F.col("o_orderkey") % 7 != 0).alias("o_orderkey"))


def orphan_facts(spark: SparkSession, d: str) -> DataFrame:
    return A.orphans(table(spark, d, "lineitem"), _most_orders(spark, d), "l_orderkey", "o_orderkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


ORPHAN_FACTS = "SELECT count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0)"


def orphan_fks(spark: SparkSession, d: str) -> DataFrame:
    return A.orphans(table(spark, d, "lineitem"), _most_orders(spark, d), "l_orderkey", "o_orderkey")


ORPHAN_FKS = "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0) GROUP BY 1"


def future_by_source(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"))
    c = table(spark, d, "customer").select(_other("c_custkey", F.col("c_custkey") % 5 != 0).alias("o_custkey"), "c_mktsegment")
    return o.join(c, "o_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_mktsegment")


FUTURE_BY_SOURCE = "SELECT c_mktsegment, count(*) AS n FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey WHERE o_orderdate > TIMESTAMP '1997-01-01' GROUP BY 1"


def distribution(spark: SparkSession, d: str) -> DataFrame:
    return A.distribution(table(spark, d, "supplier"), "s_nationkey")


DISTRIBUTION = "SELECT s_nationkey, count(*) AS n, CASE WHEN count(*) < 5 THEN 'WARN' ELSE 'ok' END AS flag FROM supplier GROUP BY 1"


def freshness(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    x = A.freshness(o, "o_orderdate", F.lit(_NOW).cast("timestamp"), 30)
    return x.select("recent", F.date_format("latest", "yyyy-MM-dd").alias("latest"), F.date_format("first", "yyyy-MM-dd").alias("first"), "days_since")


FRESHNESS = f"SELECT count(*) FILTER (o_orderdate > TIMESTAMP '{_NOW}' - INTERVAL 30 DAY) AS recent, strftime(max(o_orderdate), '%Y-%m-%d') AS latest, strftime(min(o_orderdate), '%Y-%m-%d') AS first, CAST(date_diff('day', max(o_orderdate)::DATE, DATE '{_NOW}') AS INTEGER) AS days_since FROM orders"


def outliers(spark: SparkSession, d: str) -> DataFrame:
    return A.outliers(table(spark, d, "customer"), "balance", "c_acctbal", 9000.0)


OUTLIERS = "SELECT 'balance' AS section, metric, value, total FROM (SELECT 'below_zero' AS metric, count(*) FILTER (c_acctbal < 0) AS value, count(*) AS total FROM customer UNION ALL SELECT 'above_most', count(*) FILTER (c_acctbal > 9000), count(*) FROM customer)"


def severity_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The nightly audit's rules over line items as prices, orders as facts and customers as dimension."""
    x, o, c = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    metrics = [
        A.fused_counts(x, "prices", A.price_logic("l_tax", "l_discount", "l_quantity")),
        A.outliers(c, "arrivals", "c_acctbal", 9000.0),
        A.fused_counts(o, "facts", {"future": F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz")}),
        A.nulls(c.select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey")).alias("market_id"), F.col("c_mktsegment").alias("commodity_alias_lookup_id")), "dims", ["market_id", "commodity_alias_lookup_id"]).select("section", "metric", "value", "total"),
        orphan_facts(spark, d).select(F.lit("facts").alias("section"), F.lit("orphans").alias("metric"), F.col("rows").alias("value"), F.lit(None).cast("bigint").alias("total")),
        dup_totals(spark, d).select(F.lit("facts").alias("section"), F.lit("duplicates").alias("metric"), F.col("groups").alias("value"), F.lit(None).cast("bigint").alias("total")),
        orphan_dims(spark, d).agg(F.count("*").alias("value")).select(F.lit("dims").alias("section"), F.lit("childless").alias("metric"), "value", F.lit(None).cast("bigint").alias("total")),
    ]
    every = metrics[0]
    for m in metrics[1:]:
        every = every.unionByName(m)
    return A.rollup(every, A.rules(spark))


_RULES_SQL = ", ".join(str(r) for r in A.RULES)
SEVERITY_ROLLUP = f"""
WITH rules(section, metric, level, message) AS (VALUES {_RULES_SQL}),
m AS (
  SELECT 'prices' AS section, unnest(['min_above_max', 'modal_above_max', 'modal_below_min', 'negative', 'zero']) AS metric,
         unnest([count(*) FILTER (l_tax > l_discount), count(*) FILTER (l_quantity > l_discount), count(*) FILTER (l_quantity < l_tax), count(*) FILTER (l_tax < 0 OR l_discount < 0 OR l_quantity < 0), count(*) FILTER (l_tax = 0 OR l_discount = 0 OR l_quantity = 0)]) AS value FROM lineitem
  UNION ALL SELECT 'arrivals', unnest(['below_zero', 'above_most']), unnest([count(*) FILTER (c_acctbal < 0), count(*) FILTER (c_acctbal > 9000)]) FROM customer
  UNION ALL SELECT 'facts', 'future', count(*) FILTER (o_orderdate > TIMESTAMP '1998-01-01') FROM orders
  UNION ALL SELECT 'dims', 'market_id', count(*) FILTER (c_custkey % 11 = 0) FROM customer
  UNION ALL SELECT 'facts', 'orphans', rows FROM ({ORPHAN_FACTS}) UNION ALL SELECT 'facts', 'duplicates', groups FROM ({DUP_TOTALS}) UNION ALL SELECT 'dims', 'childless', count(*) FROM ({ORPHAN_DIMS}))
SELECT level, section, metric, value::BIGINT AS value, message FROM m JOIN rules USING (section, metric) WHERE value > 0"""


def cross_source_overlap(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").withColumn("source", F.when(F.col("doc_id") % 13 != 0, F.col("source")))
    return A.source_overlap(x, [F.md5(F.lower("text")).alias("k")], "source")


CROSS_SOURCE_OVERLAP = """
WITH k AS (SELECT md5(lower(text)) AS k, array_to_string(list_sort(list(DISTINCT x)), '|') AS sources, count(DISTINCT x) AS s, count(*) AS n FROM (SELECT text, CASE WHEN doc_id % 13 <> 0 THEN source ELSE '' END AS x FROM documents) GROUP BY 1)
SELECT sources, count(*) AS keys, sum(n)::BIGINT AS docs FROM k WHERE s > 1 GROUP BY 1"""


def name_variants(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("name", F.when(F.col("p_partkey") % 6 != 0, F.col("p_type")))
    return A.variants(p, ["p_brand", "p_size"], "name")


NAME_VARIANTS = "SELECT p_brand, p_size, count(*) AS n, count(DISTINCT t) AS n_names, array_to_string(list_sort(list(DISTINCT t)), '|') AS names FROM (SELECT *, CASE WHEN p_partkey % 6 <> 0 THEN p_type ELSE '' END AS t FROM part) GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT t) > 1"


def alias_collisions(spark: SparkSession, d: str) -> DataFrame:
    return A.variants(table(spark, d, "part").withColumn("lookup", F.col("p_partkey") % 97), ["lookup"], "p_name").select("lookup", "n", "n_names").orderBy(F.desc("n_names"), F.desc("n"), "lookup")


ALIAS_COLLISIONS = "SELECT p_partkey % 97 AS lookup, count(*) AS n, count(DISTINCT p_name) AS n_names FROM part GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT p_name) > 1"


def lookup_key_dups(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("brand", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")))
    return p.groupBy("p_size").agg(F.count("*").alias("n"), A.null_safe_distinct(F.col("brand")).alias("n_brands"))


LOOKUP_KEY_DUPS = "SELECT p_size, count(*) AS n, count(DISTINCT CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE '' END) AS n_brands FROM part GROUP BY 1"


def uniqueness(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    return A.uniqueness(x, {"line": ["l_orderkey", "l_linenumber"], "part": ["l_orderkey", "l_partkey"]})


UNIQUENESS = """
WITH a AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber), b AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)
SELECT 'line' AS constraint, sum(n)::BIGINT AS rows, count(*) AS keys, max(n) <= 1 AS holds FROM a UNION ALL SELECT 'part', sum(n)::BIGINT, count(*), max(n) <= 1 FROM b"""


def alias_health(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.when(F.col("p_partkey") % 6 == 0, F.array().cast("array<string>")).when(F.col("p_partkey") % 6 != 1, F.array("p_name")).alias("aliases"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).otherwise("").alias("crop_master_id"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")).alias("location"), F.when(F.col("p_partkey") % 8 != 0, F.col("p_type")).alias("state"), (F.col("p_size") / 50.0).alias("confidence"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey") % 3 == 1).alias("active"))
    return A.array_health(p, "alias", "aliases", "crop_master_id").union(A.geo_health(p, "geo")).union(A.collection_stats(p, "stats"))


ALIAS_HEALTH = """
WITH t AS (SELECT count(*) AS total, count(*) FILTER (p_partkey % 6 <= 1) AS a, count(*) FILTER (p_partkey % 5 = 0) AS b, count(*) FILTER (p_partkey % 9 = 0) AS c, count(*) FILTER (p_partkey % 8 = 0) AS e,
                  count(*) FILTER (p_size / 50.0 < 0.8 AND p_partkey % 3 <> 2) AS f FROM part)
SELECT 'alias' AS section, 'no_aliases' AS metric, a AS value, total FROM t UNION ALL SELECT 'alias', 'no_crop_id', b, total FROM t UNION ALL SELECT 'geo', 'no_location', c, total FROM t
UNION ALL SELECT 'geo', 'no_state', e, total FROM t UNION ALL SELECT 'stats', 'unmapped', 0, total FROM t UNION ALL SELECT 'stats', 'unsure', f, total FROM t"""


def top_groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_type").limit(40)


TOP_GROUPS = "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 40"


def predicates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("active", F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey") % 3 == 1))
    name = F.lower("p_name")
    return p.agg(
        F.count_if(F.coalesce("active", F.lit(True))).alias("active_or_null"),
        F.count_if(F.lower("p_brand") == "brand#11").alias("same_ignoring_case"),
        F.count_if(name.contains("ring") | F.exists(F.split(F.lower("p_type"), " "), lambda t: t.contains("st"))).alias("substring"),
        F.count_if(F.col("p_size").isin(1, 5, 9) & ~F.col("p_brand").isin("Brand#11")).alias("in_and_not_in"),
        F.count_if(F.size(F.array_distinct(F.split(F.lower("p_name"), ""))) > 6).alias("array_size"),
    )


PREDICATES = """
SELECT count(*) FILTER (p_partkey % 3 <> 2) AS active_or_null, count(*) FILTER (lower(p_brand) = 'brand#11') AS same_ignoring_case,
       count(*) FILTER (contains(lower(p_name), 'ring') OR contains(lower(p_type), 'st')) AS substring,
       count(*) FILTER (p_size IN (1, 5, 9) AND p_brand NOT IN ('Brand#11')) AS in_and_not_in,
       count(*) FILTER (len(list_distinct(string_split(lower(p_name), ''))) > 6) AS array_size
FROM part"""

QUERIES = {k: (globals()[k], globals()[k.upper()]) for k in "null_scan null_totals quality_holes unmatched_names price_logic dup_groups dup_rows dup_totals orphan_dims orphan_facts orphan_fks future_by_source distribution freshness outliers severity_rollup cross_source_overlap name_variants alias_collisions lookup_key_dups uniqueness alias_health top_groups predicates".split()}
