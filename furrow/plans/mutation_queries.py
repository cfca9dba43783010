"""Queries over merges, repairs and the review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import scalars as X
from furrow.operators import merge as M
from furrow.operators import repair, review, star
from furrow.plans.tables import table
from furrow.session import fresh_path
from furrow.sources.specs import NATIONAL


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("day", F.to_date("ts"))


def _history(spark: SparkSession, d: str, policies: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Events as rows of a table with the columns of policies, in order of days: those up to the 15th of a month, and the later ones."""
    e = table(spark, d, "events")
    own = {"increment": F.lit(1).cast("bigint"), "set_union": F.array("event_type")}
    text = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("v"), F.col("event_id").cast("string")))
    order = (F.dayofmonth("ts").cast("bigint") * 1_000_000_000 + F.col("event_id")).alias("ordinal")
    rows = e.select(F.col("user_id").alias("k"), order, (F.dayofmonth("ts") <= 15).alias("early"), *(own.get(p, text).alias(c) for c, p in policies.items()))
    return rows.where("early").drop("early"), rows.where("not early").drop("early")


def _policy_query(policies: dict[str, str]):
    def query(spark: SparkSession, d: str) -> DataFrame:
        """A table as the first half leaves it, merged with the second half."""
        old, new = _history(spark, d, policies)
        out = M.merge(M.fold_batch(old, ["k"], policies), new, ["k"], policies)
        return out.select("k", *(F.array_join(c, "|").alias(c) if p == "set_union" else F.col(c) for c, p in policies.items()), "action")

    return query


def _policy_sql(policies: dict[str, str]) -> str:
    def value(p: str) -> str:
        return {
            "insert_only": "first(v ORDER BY o)",
            "overwrite_even_null": "last(v ORDER BY o)",
            "overwrite": "last(v ORDER BY o) FILTER (v IS NOT NULL)",
            "coalesce_old": "first(v ORDER BY o) FILTER (v IS NOT NULL)",
            "increment": "count(*)",
            "set_union": "array_to_string(list_sort(list(DISTINCT event_type)), '|')",
        }[p]

    columns = ", ".join(f"{value(p)} AS {c}" for c, p in policies.items())
    return f"""
WITH x AS (SELECT user_id, event_type, day(ts) AS dm, day(ts) * 1000000000 + event_id AS o, CASE WHEN event_id % 3 <> 0 THEN 'v' || event_id END AS v FROM events)
SELECT user_id AS k, {columns}, CASE WHEN bool_and(dm > 15) THEN 'insert' WHEN bool_or(dm > 15) THEN 'update' ELSE 'keep' END AS action FROM x GROUP BY user_id"""


_POLICIES = {"dim_upsert": M.DIM, "fact_upsert": M.FACT, "review_upsert": M.REVIEW, "suggestion_upsert": M.SUGGESTION, "market_upsert": M.MARKET, "alias_upsert": M.ALIAS}


def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a day: the last row of a key wins, nulls and all."""
    e = _daily(spark, d).select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"), "event_type")
    return M.fold_batch(e, ["user_id", "day"], {"value": "overwrite_even_null", "event_type": "overwrite_even_null"}, "event_id")


UPSERT_LAST_WINS = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, last(CASE WHEN event_id % 4 <> 0 THEN value END ORDER BY event_id) AS value, last(event_type ORDER BY event_id) AS event_type FROM events GROUP BY 1, 2"""


def upsert_policy(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("first_type"), F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("last_type"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("seen"), F.lit(1).cast("bigint").alias("times"), F.array("event_type").alias("types"))
    policies = {"first_type": "insert_only", "last_type": "overwrite_even_null", "seen": "overwrite", "times": "increment", "types": "set_union"}
    old = M.fold_batch(e.where("event_id % 2 = 0"), ["user_id"], policies, "event_id")
    out = M.merge(old, e.where("event_id % 2 = 1"), ["user_id"], policies, "event_id")
    return out.withColumn("types", F.array_join("types", "|"))


UPSERT_POLICY = """
WITH x AS (SELECT user_id, event_id % 2 AS b, event_id, event_type FROM events),
f AS (SELECT user_id, b, arg_min(event_type, event_id) AS first_type, max(event_id) AS last_id, max(event_id) FILTER (event_id % 3 <> 0) AS seen, count(*) AS times FROM x GROUP BY 1, 2),
l AS (SELECT f.user_id, f.b, CASE WHEN last_id % 5 <> 0 THEN event_type END AS last_type FROM f JOIN events ON event_id = last_id),
t AS (SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS types FROM events GROUP BY 1)
SELECT t.user_id, CASE WHEN o.user_id IS NOT NULL THEN o.first_type ELSE n.first_type END AS first_type, CASE WHEN n.user_id IS NOT NULL THEN ln.last_type ELSE lo.last_type END AS last_type,
       coalesce(n.seen, o.seen) AS seen, coalesce(o.times, 0) + coalesce(n.times, 0) AS times, types,
       CASE WHEN o.user_id IS NOT NULL AND n.user_id IS NOT NULL THEN 'update' WHEN n.user_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS action
FROM t LEFT JOIN f o ON o.user_id = t.user_id AND o.b = 0 LEFT JOIN f n ON n.user_id = t.user_id AND n.b = 1
LEFT JOIN l lo ON lo.user_id = t.user_id AND lo.b = 0 LEFT JOIN l ln ON ln.user_id = t.user_id AND ln.b = 1"""


def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    return M.merge_stats(upsert_policy(spark, d))


MERGE_STATS = """
WITH u AS (SELECT user_id, bool_or(event_id % 2 = 0) AS o, bool_or(event_id % 2 = 1) AS n FROM events GROUP BY 1)
SELECT count(*) FILTER (n AND NOT o) AS insert_rows, count(*) FILTER (n AND o) AS update_rows, count(*) FILTER (o AND NOT n) AS keep_rows FROM u"""


def backfill_fk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.lit("own")).alias("segment"))
    found = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey")).alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return repair.backfill(rows, found, ["o_custkey"], "segment").select("o_orderkey", "segment", "action")


BACKFILL_FK = """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN 'own' END, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END) AS segment,
       CASE WHEN o_orderkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'fill' ELSE 'keep' END AS action FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""


def source_merge(spark: SparkSession, d: str) -> DataFrame:
    facts = _daily(spark, d).select("event_id", (F.col("user_id") * 2 + (F.col("event_id") % 2)).alias("fk"), F.date_format("day", "yyyy-MM-dd").alias("day"), "user_id")
    pairs = facts.groupBy("user_id").agg(F.min("fk").alias("a"), F.max("fk").alias("b")).where("a <> b").select(F.col("a").alias("keep_id"), F.col("b").alias("old_id"))
    plan = repair.merge_sources(facts.drop("user_id"), pairs, "fk", "day", "event_id")
    return plan.select("event_id", "fk", "target", "day", "action")


SOURCE_MERGE = """
WITH f AS (SELECT event_id, user_id * 2 + event_id % 2 AS fk, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events),
p AS (SELECT min(fk) AS keep_id, max(fk) AS old_id FROM f GROUP BY user_id HAVING min(fk) <> max(fk)),
m AS (SELECT event_id, fk, day, coalesce(keep_id, fk) AS target, keep_id IS NOT NULL AS is_old FROM f LEFT JOIN p ON old_id = fk),
r AS (SELECT *, row_number() OVER (PARTITION BY target, day ORDER BY is_old, event_id) AS nth FROM m)
SELECT event_id, fk, target, day, CASE WHEN NOT is_old THEN 'keep' WHEN nth = 1 THEN 'remap' ELSE 'drop' END AS action FROM r"""


def swap_repair(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    plan = repair.swap_plan(o, "o_custkey", "o_orderdate", F.lit("1998-02-01").cast("timestamp"))
    return plan.select("o_orderkey", F.date_format("new_date", "yyyy-MM-dd").alias("new_date"), "action")


SWAP_REPAIR = """
WITH f AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS dt, CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE o_orderdate::DATE END AS nd FROM orders WHERE o_orderdate > TIMESTAMP '1998-02-01')
SELECT o_orderkey, strftime(nd, '%Y-%m-%d') AS new_date, CASE WHEN day(dt) > 12 OR nd = dt OR nd > DATE '1998-02-01' OR EXISTS (SELECT 1 FROM orders x WHERE x.o_custkey = f.o_custkey AND x.o_orderdate::DATE = nd) THEN 'delete' ELSE 'move' END AS action FROM f"""


def delete_source(spark: SparkSession, d: str) -> DataFrame:
    dim = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    facts = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    left_dim, left_facts = repair.delete_source(dim, facts, "c_mktsegment", "BUILDING", "o_custkey", "o_orderdate", "1993-01-01", "1998-12-31")
    return left_dim.select(F.lit("dim").alias("t"), "id").union(left_facts.select(F.lit("fact").alias("t"), "o_orderkey"))


DELETE_SOURCE = """
WITH gone AS (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderdate::DATE BETWEEN DATE '1993-01-01' AND DATE '1998-12-31'),
f AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone))
SELECT 'dim' AS t, c_custkey AS id FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey IN (SELECT o_custkey FROM f) UNION ALL SELECT 'fact', o_orderkey FROM f"""


def _renamed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    dim = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_size", F.when(F.col("p_partkey") % 2 == 0, "new").otherwise("old").alias("label"))
    facts = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fact"), F.col("l_partkey").alias("fk"), F.date_format("l_shipdate", "yyyy-MM").alias("day"))
    return repair.rename_source(dim, facts, "label", "old", "new", ["p_brand", "p_size"], "fk", "day", "fact")


def rename_source(spark: SparkSession, d: str) -> DataFrame:
    """Entries of an old label get the new one; those that then double an entry are merged into it."""
    return _renamed(spark, d)[0].select("id", "p_brand", "p_size", "label")


_PAIRS_SQL = """
p AS (SELECT min(p_partkey) FILTER (p_partkey % 2 = 0) AS keep_id, min(p_partkey) FILTER (p_partkey % 2 = 1) AS old_id FROM part GROUP BY p_brand, p_size
      HAVING count(*) FILTER (p_partkey % 2 = 0) > 0 AND count(*) FILTER (p_partkey % 2 = 1) > 0)"""
RENAME_SOURCE = f"WITH {_PAIRS_SQL} SELECT p_partkey AS id, p_brand, p_size, 'new' AS label FROM part WHERE p_partkey NOT IN (SELECT old_id FROM p)"


def rename_facts(spark: SparkSession, d: str) -> DataFrame:
    return _renamed(spark, d)[1].select("fact", "fk", "target", "day", "action")


RENAME_FACTS = f"""
WITH {_PAIRS_SQL},
m AS (SELECT l_orderkey * 10 + l_linenumber AS fact, l_partkey AS fk, strftime(l_shipdate, '%Y-%m') AS day, coalesce(keep_id, l_partkey) AS target, keep_id IS NOT NULL AS is_old FROM lineitem LEFT JOIN p ON old_id = l_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY target, day ORDER BY is_old, fact) AS nth FROM m)
SELECT fact, fk, target, day, CASE WHEN NOT is_old THEN 'keep' WHEN nth = 1 THEN 'remap' ELSE 'drop' END AS action FROM r"""


def orphan_deletes(spark: SparkSession, d: str) -> DataFrame:
    parent = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey")).alias("id"))
    plan = repair.orphan_facts(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), parent, "l_orderkey")
    return plan.select("l_orderkey", "l_linenumber", "action")


ORPHAN_DELETES = "SELECT l_orderkey, l_linenumber, 'delete' AS action FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0)"


def _imported(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as entries of the alias table (last digits 0 to 3) and as rows of an import: new names, names known by alias, and names of others."""
    p, none = table(spark, d, "part").withColumn("k", F.col("p_partkey") % 10), F.lit(None).cast("string")
    at = lambda word, back: F.concat(F.lit(word), (F.col("p_partkey") - back).cast("string"))
    canonical = F.lower(F.concat_ws(" ", "p_name", "p_partkey"))
    lookup = p.where("k <= 3").select(F.concat(F.lit("L"), "p_partkey").alias("id"), canonical.alias("canonical_name"), none.alias("crop_master_id"), F.array(at("alias ", 0), canonical).alias("aliases"), F.array(F.lit("table")).alias("source_tags"), F.lit(0.5).alias("confidence"), F.lit(True).alias("active"), F.lit("old").alias("notes"))
    name = F.when(F.col("k") == 4, at("New ", 0)).when(F.col("k") == 5, at("ALIAS ", 5)).otherwise(at(" Other ", 0))
    target = F.when(F.col("k") == 7, at("New ", 3)).when(F.col("k") == 8, at("Alias ", 5)).when(F.col("k") == 9, at("Missing ", 0)).otherwise(" ")
    rows = p.where("k > 3").select(F.col("p_partkey").alias("ordinal"), name.alias("name"), F.when(F.col("k") == 6, at("Alias ", 4)).alias("canonical_name"), F.concat(F.lit("x, Extra "), "p_partkey").alias("additional_aliases"), F.when(F.col("k") == 6, F.concat(F.lit("crop"), "p_partkey")).otherwise("").alias("crop_master_id"), target.alias("duplicates"), F.when(F.col("k") == 5, at("note ", 0)).alias("notes"))
    return repair.import_aliases(lookup, rows)


def import_aliases(spark: SparkSession, d: str) -> DataFrame:
    return _imported(spark, d)[0].select("id", "canonical_name", "crop_master_id", F.array_join("aliases", "|").alias("aliases"), "confidence", "notes", "action")


_IMPORT_SQL = """
b AS (SELECT p_partkey AS p, p_partkey % 10 AS k, lower(p_name) || ' ' || p_partkey AS canonical FROM part),
r AS (SELECT p, k, CASE k WHEN 4 THEN 'new ' || p WHEN 5 THEN 'alias ' || p - 5 ELSE 'other ' || p END AS name, CASE k WHEN 4 THEN 'new ' || p WHEN 5 THEN 'alias ' || p - 5 WHEN 6 THEN 'alias ' || p - 4 WHEN 7 THEN 'new ' || p - 3 WHEN 8 THEN 'alias ' || p - 5 ELSE 'missing ' || p END AS canon,
             CASE k WHEN 4 THEN NULL WHEN 5 THEN 'L' || p - 5 WHEN 6 THEN 'L' || p - 4 WHEN 8 THEN 'L' || p - 5 END AS old_id FROM b WHERE k > 3),
i AS (SELECT *, coalesce(old_id, md5(canon)) AS id FROM r)"""
IMPORT_ALIASES = f"""
WITH {_IMPORT_SQL},
a AS (
  SELECT 'L' || p AS id, unnest(['alias ' || p, canonical]) AS alias FROM b WHERE k <= 3
  UNION ALL SELECT id, unnest(list_concat(['x', 'extra ' || p, name], CASE WHEN k IN (5, 6) THEN [canon] WHEN k = 9 THEN [canon] ELSE [] END)) FROM i),
g AS (SELECT id, array_to_string(list_sort(list(DISTINCT alias)), '|') AS aliases FROM a GROUP BY 1),
n AS (SELECT id, min(canon) AS canon, max(CASE WHEN k = 6 THEN 'crop' || p END) AS crop, max(CASE WHEN k = 5 THEN 'note ' || p END) AS note FROM i GROUP BY 1)
SELECT g.id, coalesce(b.canonical, n.canon) AS canonical_name, n.crop AS crop_master_id, aliases, CASE WHEN b.p IS NOT NULL THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS confidence, coalesce(n.note, CASE WHEN b.p IS NOT NULL THEN 'old' END) AS notes,
       CASE WHEN b.p IS NULL THEN CASE WHEN n.canon LIKE 'new %' THEN CASE WHEN EXISTS (SELECT 1 FROM r x WHERE x.k = 7 AND x.canon = n.canon) THEN 'update' ELSE 'keep' END WHEN n.canon LIKE 'missing %' THEN 'insert' ELSE 'keep' END WHEN EXISTS (SELECT 1 FROM r x WHERE x.k = 8 AND x.old_id = g.id) THEN 'update' ELSE 'keep' END AS action
FROM g LEFT JOIN b ON b.k <= 3 AND 'L' || b.p = g.id LEFT JOIN n ON n.id = g.id"""


def import_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Entries without a crop get the id of their name's entry."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 5, F.concat(F.lit("Alias "), (F.col("p_partkey") - 5).cast("string"))).otherwise(F.concat(F.lit("New "), "p_partkey")).alias("commodity_name"), F.when(F.col("p_partkey") % 3 == 0, "own").alias("commodity_alias_lookup_id"))
    low = p.withColumn("name", F.lower("commodity_name"))
    return repair.backfill(low, _imported(spark, d)[1], ["name"], "commodity_alias_lookup_id").select("p_partkey", "commodity_alias_lookup_id", "action")


IMPORT_BACKFILL = f"""
WITH {_IMPORT_SQL}, m AS (SELECT name, last(id ORDER BY p) AS id FROM i GROUP BY 1),
q AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 5 THEN 'alias ' || p_partkey - 5 ELSE 'new ' || p_partkey END AS name, CASE WHEN p_partkey % 3 = 0 THEN 'own' END AS own FROM part)
SELECT p_partkey, coalesce(own, id) AS commodity_alias_lookup_id, CASE WHEN own IS NULL AND id IS NOT NULL THEN 'fill' ELSE 'keep' END AS action FROM q LEFT JOIN m USING (name)"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Harmonised rows from events: a third of crops have no alias entry, a quarter of markets no id, some names and sources are missing or empty."""
    e = table(spark, d, "events")
    blank = lambda c, k: F.when(F.col("event_id") % k == 0, F.lit("")).when(F.col("event_id") % k == 1, F.lit(None)).otherwise(c)
    market, crop = F.concat(F.lit("m"), (F.col("user_id") % 40).cast("string")), F.concat(F.col("event_type"), (F.col("user_id") % 3).cast("string"))
    return e.select(
        blank(F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")), 29).alias("source"), F.when(F.col("event_id") % 58 != 0, "feed").alias("source_system"), blank(F.concat(F.lit("st"), (F.col("user_id") % 5).cast("string")), 31).alias("state"), blank(market, 17).alias("market_name"), blank(crop, 19).alias("commodity_name"), F.lit(None).cast("string").alias("variety"),
        F.when(F.col("user_id") % 4 != 0, market).alias("market_id"), F.when(F.col("user_id") % 3 != 0, crop).alias("commodity_alias_lookup_id"),
        F.col("ts").cast("timestamp").alias("date"), ((F.col("event_id") % 50) / 4).alias("min_price"), ((F.col("event_id") % 70) / 4).alias("max_price"), F.lit(None).cast("double").alias("modal_price"), F.col("event_id").alias("ordinal"))


def _blank(value: str, k: int, empty: str = "NULL") -> str:
    return f"CASE event_id % {k} WHEN 0 THEN {empty} WHEN 1 THEN NULL ELSE {value} END"


#: Empty names are none; raw_state is as it stands, for keys.
_ROWS_SQL = f"""r AS (SELECT coalesce({_blank("'s' || event_id % 4", 29)}, CASE WHEN event_id % 58 <> 0 THEN 'feed' END, 'unknown') AS source, CASE WHEN event_id % 58 <> 0 THEN 'feed' END AS system, coalesce({_blank("'st' || user_id % 5", 31)}, 'unknown') AS state, {_blank("'st' || user_id % 5", 31, "''")} AS raw_state,
  {_blank("'m' || user_id % 40", 17)} AS market, {_blank("event_type || user_id % 3", 19)} AS crop, {_blank("'m' || user_id % 40", 17, "''")} AS raw_market, {_blank("event_type || user_id % 3", 19, "''")} AS raw_crop, user_id % 4 = 0 AS no_market, user_id % 3 = 0 AS no_crop, (event_id % 50) / 4.0::DOUBLE AS lo, (event_id % 70) / 4.0::DOUBLE AS hi, event_id, strftime(ts, '%Y-%m-%d') AS day FROM events)"""


def run_stats(spark: SparkSession, d: str) -> DataFrame:
    return review.run_stats(_rows(spark, d))


RUN_STATS = f"WITH {_ROWS_SQL} SELECT source, state, count(*) AS records, count(DISTINCT market) AS markets, count(DISTINCT CASE WHEN no_crop THEN crop END) AS unmapped_commodities, count(DISTINCT CASE WHEN no_market THEN market END) AS unknown_markets FROM r GROUP BY 1, 2"


def _status(spark: SparkSession, d: str) -> DataFrame:
    """What became of each source, from events: s2 failed, s1 gave nothing, a fifth of the events are the national feed's."""
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 5 == 4, NATIONAL).otherwise(F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string"))).alias("source"))
    failed = F.col("source") == "s2"
    return e.groupBy("source").agg(F.count("*").alias("n")).select("source", (~failed).alias("success"), F.when(failed, "scrape failed").alias("error"), F.when(failed, "timeout").alias("details"), F.when(F.col("source").isin("s1", "s2"), 0).otherwise(F.col("n")).cast("bigint").alias("records"))


_STATUS_SQL = f"""st AS (SELECT source, source <> 's2' AS success, CASE WHEN source IN ('s1', 's2') THEN 0 ELSE count(*) END AS records FROM (SELECT CASE WHEN event_id % 5 = 4 THEN '{NATIONAL}' ELSE 's' || event_id % 4 END AS source FROM events) GROUP BY 1)"""


def pipeline_row(spark: SparkSession, d: str) -> DataFrame:
    docs = review.run_documents(run_stats(spark, d), _status(spark, d), "run1")
    return review.pipeline_row(docs).withColumn("sources_failed", F.array_join("sources_failed", "|"))


PIPELINE_ROW = f"WITH {_ROWS_SQL}, {_STATUS_SQL} SELECT '_pipeline' AS source, false AS success, (SELECT sum(records) FROM st)::BIGINT AS records_fetched, (SELECT count(*) FROM r WHERE source IN (SELECT source FROM st)) AS records_normalised, 's2' AS sources_failed"


def _documents(spark: SparkSession, d: str, run_id: str) -> DataFrame:
    docs = review.run_documents(run_stats(spark, d), _status(spark, d), run_id)
    return docs.withColumn("states", F.array_join(F.transform("states", lambda s: F.concat_ws(":", *(s[c] for c in ("state", "records", "markets", "unmapped_commodities", "unknown_markets")))), "|"))


def run_documents(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d, "run1")


_DOCUMENTS_SQL = f"""
{_ROWS_SQL}, {_STATUS_SQL},
s AS (SELECT source, state, count(*) AS n, count(DISTINCT market) AS m, count(DISTINCT CASE WHEN no_crop THEN crop END) AS u, count(DISTINCT CASE WHEN no_market THEN market END) AS w FROM r GROUP BY 1, 2),
g AS (SELECT source, array_to_string(list(concat_ws(':', state, n, m, u, w) ORDER BY state), '|') AS states, sum(n)::BIGINT AS n FROM s GROUP BY 1),
docs AS (SELECT st.source, success, CASE WHEN NOT success THEN 'scrape failed: timeout' END AS error, records::BIGINT AS records_fetched, coalesce(n, 0) AS records_normalised, states FROM st LEFT JOIN g USING (source))"""
RUN_DOCUMENTS = f"WITH {_DOCUMENTS_SQL} SELECT 'run1' AS run_id, * FROM docs"


def run_history(spark: SparkSession, d: str) -> DataFrame:
    """Documents of two runs, appended to one table."""
    path = fresh_path(spark, "runs")
    for run in ("run1", "run2"):
        review.append_run(_documents(spark, d, run), path)
    return spark.read.parquet(path)


RUN_HISTORY = f"WITH {_DOCUMENTS_SQL} SELECT 'run1' AS run_id, * FROM docs UNION ALL SELECT 'run2', * FROM docs"


def review_items(spark: SparkSession, d: str) -> DataFrame:
    items = review.review_items(_rows(spark, d), _status(spark, d), "run1", F.lit("2026-10-31").cast("timestamp"))
    lists = [F.array_join(c, "|").alias(c) for c in ("states", "sources", "sample_markets", "sample_commodities")]
    return items.select("key", "type", "status", "title", "details", "state", "source", F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"), "last_run_id", "times_seen", "records_seen", *lists)


def _sorted(x: str, most: int | None = None) -> str:
    return f"array_to_string(list_sort(list(DISTINCT {x}) FILTER ({x} IS NOT NULL)){f'[1:{most}]' if most else ''}, '|')"


REVIEW_ITEMS = f"""
WITH {_ROWS_SQL},
bad AS (SELECT *, lo <= 0 AS b1, hi <= 0 AS b2, lo > hi AS b3 FROM r WHERE lo <= 0 OR hi <= 0 OR lo > hi ORDER BY event_id LIMIT 500),
i AS (
  SELECT 'run_failed|s2|2026-10-31' AS key, 'run_failed' AS type, 's2 scrape failed on 2026-10-31' AS title, '{{"error":"timeout","date":"2026-10-31"}}' AS details, NULL AS state, 's2' AS source, 0 AS n, '' AS states, '' AS sources, '' AS sample_markets, '' AS sample_commodities
  UNION ALL SELECT 'unmapped_commodity|' || crop, 'unmapped_commodity', 'Crop name not matched: ' || crop, '{{"commodity_name":"' || crop || '"}}', NULL, NULL, count(*), {_sorted("state")}, {_sorted("coalesce(system, source)")}, {_sorted("market", 10)}, '' FROM r WHERE no_crop AND crop IS NOT NULL GROUP BY crop
  UNION ALL SELECT 'unknown_market|' || state || '|' || market, 'unknown_market', 'Market not found: ' || market || ' (' || state || ')', '{{"market_name":"' || market || '"}}', state, NULL, count(*), '', {_sorted("coalesce(system, source)")}, '', {_sorted("crop", 10)} FROM r WHERE no_market AND market IS NOT NULL GROUP BY state, market
  UNION ALL SELECT concat_ws('|', 'price_invalid', coalesce(system, 'None'), coalesce(raw_state, 'None'), coalesce(raw_market, 'None'), coalesce(raw_crop, 'None'), 'None', day), 'price_invalid', 'Price looks wrong: ' || coalesce(raw_crop, 'None') || ' at ' || coalesce(raw_market, 'None') || ' on ' || day,
    '{{"problems":[' || concat_ws(',', CASE WHEN b1 THEN '"min price is ' || printf('%g', lo) || '"' END, CASE WHEN b2 THEN '"max price is ' || printf('%g', hi) || '"' END, CASE WHEN b3 THEN '"min price ' || printf('%g', lo) || ' is above max price ' || printf('%g', hi) || '"' END) || ']'
      || coalesce(',"market_name":"' || raw_market || '"', '') || coalesce(',"commodity_name":"' || raw_crop || '"', '') || ',"date":"' || day || '","min_price":' || lo || ',"max_price":' || hi || '}}', raw_state, system, 1, '', '', '', '' FROM bad)
SELECT key, type, 'open' AS status, title, details, state, source, '2026-10-31' AS first_seen, 'run1' AS last_run_id, 1::BIGINT AS times_seen, n::BIGINT AS records_seen, states, sources, sample_markets, sample_commodities FROM i"""


def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    return review.overall_status(_status(spark, d))


STATUS_ROLLUP = f"WITH {_STATUS_SQL} SELECT count(*) FILTER (success) AS ok, count(*) FILTER (NOT success) AS failed, sum(records)::BIGINT AS records, 'PARTIAL' AS status FROM st"


def source_lines(spark: SparkSession, d: str) -> DataFrame:
    return review.source_lines(_status(spark, d)).select("source", "shown", "place")


SOURCE_LINES = f"""
WITH {_STATUS_SQL} SELECT source, CASE WHEN NOT success THEN 'FAILED: scrape failed: timeout' WHEN records = 0 THEN 'SKIPPED' ELSE 'OK' END AS shown, row_number() OVER (ORDER BY source <> '{NATIONAL}', source)::INTEGER AS place FROM st"""


def report_texts(spark: SparkSession, d: str) -> DataFrame:
    """The report's subject, its recipients and a line in HTML for each source."""
    s = _status(spark, d)
    head = review.overall_status(s).select(X.report_subject(F.lit("2026-10-31").cast("date"), F.col("failed"), F.col("ok")).alias("subject"), F.array_join(X.recipients(F.lit("a@x.org; b@x.org,, c@x.org ;")), "|").alias("recipients"))
    lines = review.source_lines(s.withColumn("error", F.concat(F.lit("<b>"), "error"))).select("source", X.html_escape(F.col("shown")).alias("line"))
    return lines.crossJoin(F.broadcast(head))  # one row


REPORT_TEXTS = f"""
WITH {_STATUS_SQL} SELECT source, CASE WHEN NOT success THEN 'FAILED: &lt;b&gt;scrape failed: timeout' WHEN records = 0 THEN 'SKIPPED' ELSE 'OK' END AS line, '[PARTIAL] Price pipeline 2026-10-31' AS subject, 'a@x.org|b@x.org|c@x.org' AS recipients FROM st"""


def upload_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a run: the later half of a month's rows goes into the tables that the first half left."""
    rows = _rows(spark, d).withColumn("source_system", F.when(F.col("ordinal") % 58 != 0, "feed"))
    gone = F.col("ordinal") % 23 == 0
    rows = rows.select(*(F.when(~gone, F.col(c)).alias(c) if c in M.DIM_KEY else F.col(c) for c in rows.columns)).select("*", *(F.lit(None).cast("string").alias(c) for c in ("commodity_group", "grade", "source_url", "source_name", "method")), F.lit(None).cast("double").alias("arrival_quantity"))
    kept = rows.where(F.coalesce(*M.DIM_KEY).isNotNull())
    tables = []
    for part in (F.dayofmonth("date") <= 15, F.dayofmonth("date") > 15):
        tables.append(star.split(kept.where(part)))
    (dim0, fact0), (dim1, fact1) = tables
    day = lambda x: x.withColumn("date", F.to_date("date"))
    dim = M.merge(M.fold_batch(dim0, ["market_commodity_id"], M.DIM), dim1, ["market_commodity_id"], M.DIM)
    fact = M.merge(M.fold_batch(day(fact0), ["market_commodity_id", "date"], M.FACT), day(fact1), ["market_commodity_id", "date"], M.FACT)
    return M.upload_stats(rows.where(F.dayofmonth("date") > 15), dim, fact)


UPLOAD_STATS = f"""
WITH x AS (SELECT day(ts) <= 15 AS early, ts::DATE AS dt, event_id % 23 = 0 AS gone, CASE WHEN event_id % 58 <> 0 THEN 'feed' END AS a, {_blank("'st' || user_id % 5", 31, "''")} AS b, {_blank("'m' || user_id % 40", 17, "''")} AS c, {_blank("event_type || user_id % 3", 19, "''")} AS e FROM events),
k AS (SELECT *, concat_ws('||', coalesce(a, ''), coalesce(b, ''), coalesce(c, ''), coalesce(e, '')) AS id FROM x WHERE NOT gone AND coalesce(a, b, c, e) IS NOT NULL),
m AS (SELECT id, bool_or(early) AS o, bool_or(NOT early) AS n FROM k GROUP BY 1), p AS (SELECT id, dt, bool_or(early) AS o, bool_or(NOT early) AS n FROM k GROUP BY 1, 2)
SELECT (SELECT count(*) FROM m WHERE n AND NOT o) AS master_upserted, (SELECT count(*) FROM m WHERE n AND o) AS master_matched, (SELECT count(*) FROM p WHERE n AND NOT o) AS price_upserted, (SELECT count(*) FROM p WHERE n AND o) AS price_matched,
       (SELECT count(*) FROM x WHERE NOT early AND (gone OR coalesce(a, b, c, e) IS NULL)) AS skipped_degenerate, 0::BIGINT AS master_errors, 0::BIGINT AS price_errors, 0::BIGINT AS unresolved_combos"""


def impact_export(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    dim = p.select(F.col("p_partkey").alias("market_commodity_id"), F.lower("p_type").alias("commodity_name"), F.when(F.col("p_partkey") % 3 == 0, F.lit("x")).alias("commodity_alias_lookup_id"), F.col("p_brand").alias("state"), F.lit("feed").alias("source_system"), F.when(F.col("p_size") > 25, F.lit("big")).otherwise("").alias("variety"), F.lit(None).cast("string").alias("commodity_group"))
    facts = table(spark, d, "lineitem").select(F.col("l_partkey").alias("market_commodity_id"))
    return review.impact_export(dim, facts)


IMPACT_EXPORT = """
WITH f AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT lower(p_type) AS commodity_name, coalesce(sum(n), 0)::BIGINT AS price_record_count, count(*) AS master_doc_count, array_to_string(list_sort(list(DISTINCT p_brand)), ' | ') AS states, 'feed' AS source_systems,
       CASE WHEN max(p_size) > 25 THEN 'big' ELSE '' END AS varieties, '' AS commodity_group, '' AS canonical_name, '' AS crop_master_id, '' AS additional_aliases, '' AS notes
FROM part LEFT JOIN f ON l_partkey = p_partkey WHERE p_partkey % 3 <> 0 GROUP BY 1"""


def alias_documents(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("ordinal"), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("c"), (F.col("p_size") % 5).cast("string"))).alias("crop_master_id"), F.lower("p_brand").alias("crop_name"), F.lower("p_type").alias("market_name"), F.lit(None).cast("array<string>").alias("aliases"), F.when(F.col("p_partkey") % 100 == 0, F.concat(F.lit("n"), "p_partkey")).alias("note"))
    out = review.alias_documents(rows)
    return out.select("canonical_name", "crop_master_id", F.array_join("aliases", "|").alias("aliases"), "confidence", "notes", F.size("language_variants").alias("n_variants"))


ALIAS_DOCUMENTS = """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'c' || p_size % 5 END AS c, lower(p_brand) AS b, lower(p_type) AS ty, CASE WHEN p_partkey % 100 = 0 THEN 'n' || p_partkey END AS note FROM part),
k AS (SELECT *, coalesce(c, b) AS key FROM t)
SELECT arg_min(b, p_partkey) AS canonical_name, max(c) AS crop_master_id, array_to_string(list_sort(list_distinct(list_concat(list(b), list(ty)))), '|') AS aliases,
       CASE WHEN bool_or(c IS NULL) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence, coalesce(string_agg(note, '; ' ORDER BY p_partkey), '') AS notes, 0 AS n_variants FROM k GROUP BY key"""

QUERIES = {k: (globals()[k], globals()[k.upper()]) for k in "upsert_last_wins upsert_policy merge_stats backfill_fk source_merge swap_repair delete_source rename_source rename_facts orphan_deletes import_aliases import_backfill run_stats pipeline_row run_documents run_history review_items status_rollup source_lines report_texts upload_stats impact_export alias_documents".split()}
QUERIES |= {k: (_policy_query(p), _policy_sql(p)) for k, p in _POLICIES.items()}
