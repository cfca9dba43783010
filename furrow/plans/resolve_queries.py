"""Queries over joins and entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import scalars as X
from furrow.operators import repair, resolve, review, star
from furrow.plans.tables import table


def _markets(spark: SparkSession, d: str) -> DataFrame:
    """Entities from parts: a name in one of three states; every third has an alias, every fifth ends in apmc."""
    p = table(spark, d, "part")
    base = F.concat_ws(" ", F.lower("p_name"), F.col("p_partkey"))
    name = F.when(F.col("p_partkey") % 5 == 0, F.concat(base, F.lit("  apmc"))).otherwise(base)
    alias = F.when(F.col("p_partkey") % 3 == 0, F.array(F.concat(F.lit("old "), base))).otherwise(F.array().cast("array<string>"))
    state = F.element_at(F.array(F.lit("Odisha"), F.lit("kerala"), F.lit("assam")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return p.select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), name.alias("name"), alias.alias("aliases"), state.alias("state"))


def _probes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    base = F.concat_ws(" ", F.lower("p_name"), F.col("p_partkey"))
    k = F.col("p_partkey") % 7
    name = F.when(k == 0, F.upper(base)).when(k == 1, F.concat(F.lit("old "), base)).when(k == 2, F.concat(base, F.lit(" market"))).when(k == 3, F.concat(F.lit("no such "), base)).when(k == 4, F.concat(base, F.lit(" Sub Yard"))).otherwise(base)
    state = F.when(F.col("p_partkey") % 4 == 0, "Orissa").when(F.col("p_partkey") % 4 == 1, "keralam").when(F.col("p_partkey") % 4 == 2, "Assam")
    return p.select(name.alias("market_name"), state.alias("state"))


def tier_resolve(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_markets(_probes(spark, d), _markets(spark, d))


_ONLINE, _OFFLINE = ("|".join(x) for x in (X.MARKET_SUFFIXES, X.MARKET_SUFFIXES_OFFLINE))
_MARKETS_SQL = f"""
e AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS id, lower(p_name) || ' ' || p_partkey || CASE WHEN p_partkey % 5 = 0 THEN '  apmc' ELSE '' END AS name,
             CASE WHEN p_partkey % 3 = 0 THEN 'old ' || lower(p_name) || ' ' || p_partkey END AS alias, CASE p_partkey % 3 WHEN 0 THEN 'odisha' WHEN 1 THEN 'kerala' ELSE 'assam' END AS st FROM part),
p AS (SELECT DISTINCT CASE p_partkey % 7 WHEN 0 THEN upper(b) WHEN 1 THEN 'old ' || b WHEN 2 THEN b || ' market' WHEN 3 THEN 'no such ' || b WHEN 4 THEN b || ' Sub Yard' ELSE b END AS market_name,
             CASE p_partkey % 4 WHEN 0 THEN 'Orissa' WHEN 1 THEN 'keralam' WHEN 2 THEN 'Assam' END AS state,
             CASE p_partkey % 4 WHEN 0 THEN 'odisha' WHEN 1 THEN 'kerala' WHEN 2 THEN 'assam' END AS cst
      FROM (SELECT p_partkey, lower(p_name) || ' ' || p_partkey AS b FROM part)),
q AS (SELECT *, lower(market_name) AS k, trim(regexp_replace(lower(market_name), '\\s*({_ONLINE})\\b', '', 'g')) AS bare FROM p),
names AS (SELECT id, st, name AS n, 0 AS is_alias FROM e UNION ALL SELECT id, st, alias, 1 FROM e WHERE alias IS NOT NULL),
loose AS (SELECT id, st, regexp_replace(n, '\\s+apmc$', '') AS stem FROM names WHERE regexp_matches(n, '\\sapmc$')),
"""
TIER_RESOLVE = f"""
WITH {_MARKETS_SQL}
hits AS (
  SELECT market_name, state, 1 AS tier, id FROM q JOIN names ON n = k AND is_alias = 0 WHERE cst IS NULL OR cst = st
  UNION ALL SELECT market_name, state, 2, id FROM q JOIN names ON n = k AND is_alias = 1 WHERE cst IS NULL OR cst = st
  UNION ALL SELECT market_name, state, 3, id FROM q JOIN loose ON stem = k WHERE NOT ends_with(k, ' apmc') AND (cst IS NULL OR cst = st)
  UNION ALL SELECT market_name, state, 4, id FROM q JOIN names ON n = bare WHERE bare <> '' AND bare <> k AND (cst IS NULL OR cst = st)
  UNION ALL SELECT market_name, state, 5, id FROM q JOIN loose ON stem = bare WHERE bare <> '' AND bare <> k AND (cst IS NULL OR cst = st)
  UNION ALL SELECT market_name, state, 6, id FROM q JOIN names ON n = k),
best AS (SELECT market_name, state, min(tier * 1000000000000 + CAST(id AS BIGINT)) AS b FROM hits GROUP BY 1, 2)
SELECT q.market_name, q.state, lpad(CAST(b % 1000000000000 AS VARCHAR), 9, '0') AS market_id, CAST(b // 1000000000000 AS INTEGER) AS tier
FROM q LEFT JOIN best ON best.market_name = q.market_name AND best.state IS NOT DISTINCT FROM q.state"""


def offline_resolve(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_offline(_probes(spark, d), _markets(spark, d))


OFFLINE_RESOLVE = f"""
WITH {_MARKETS_SQL}
x AS (SELECT id, st, regexp_replace(n, '\\s+', ' ', 'g') AS n FROM names),
bares AS (SELECT id, st, trim(regexp_replace(n, '\\s*({_OFFLINE})\\b', '', 'g')) AS n FROM x),
exact AS (SELECT st, n, max(id) AS id FROM x GROUP BY 1, 2),
keys AS (SELECT * FROM exact UNION ALL SELECT st, n, min(id) FROM bares WHERE n <> '' AND (st, n) NOT IN (SELECT (st, n) FROM exact) GROUP BY 1, 2),
hits AS (
  SELECT market_name, state, 1 AS tier, id FROM q JOIN keys ON n = k AND st = cst
  UNION ALL SELECT market_name, state, 2, id FROM q JOIN keys ON n = bare AND st = cst WHERE bare <> ''
  UNION ALL SELECT market_name, state, 3, id FROM q JOIN keys ON n = k || ' apmc' AND st = cst WHERE bare <> ''
  UNION ALL SELECT market_name, state, 4, id FROM q JOIN keys ON n = bare || ' apmc' AND st = cst WHERE bare <> ''
  UNION ALL SELECT market_name, state, 5, min(id) FROM q JOIN keys ON n = k GROUP BY 1, 2),
best AS (SELECT market_name, state, min(tier * 1000000000000 + CAST(id AS BIGINT)) AS b FROM hits GROUP BY 1, 2),
r AS (SELECT q.market_name, q.state, lpad(CAST(b % 1000000000000 AS VARCHAR), 9, '0') AS market_id, CAST(b // 1000000000000 AS INTEGER) AS tier FROM q LEFT JOIN best ON best.market_name = q.market_name AND best.state IS NOT DISTINCT FROM q.state)
SELECT * FROM r"""


def new_markets(spark: SparkSession, d: str) -> DataFrame:
    """Rows for the names that no tier resolves."""
    return resolve.new_markets(tier_resolve(spark, d)).select("state", "name", "id", "source")


NEW_MARKETS = f"""
WITH t AS ({TIER_RESOLVE}), n AS (SELECT DISTINCT CASE lower(state) WHEN 'orissa' THEN 'odisha' WHEN 'keralam' THEN 'kerala' ELSE lower(state) END AS state, array_to_string(list_transform(string_split(market_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM t WHERE market_id IS NULL)
SELECT state, name, md5(coalesce(state, '') || '||' || name) AS id, 'auto_resolved' AS source FROM n"""


def alias_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    own = F.concat_ws(" ", F.lower("p_name"), F.col("p_partkey"))
    lookup = p.select(F.concat(F.lit("a"), "p_partkey").alias("id"), F.array(F.lower("p_type"), F.when(F.col("p_partkey") % 2 == 0, own).otherwise(F.concat(F.lit("other "), own))).alias("aliases"))
    names = p.select("p_partkey", F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "), "p_partkey").alias("alias_input"))
    return resolve.resolve_aliases(names, lookup).select("p_partkey", "commodity_alias_lookup_id")


ALIAS_JOIN = "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a' || p_partkey END AS commodity_alias_lookup_id FROM part"


def _part_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that grow with the parts, each close to one of the nations."""
    n = table(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("nation"))
    p = table(spark, d, "part").withColumn("n_nationkey", (F.col("p_partkey") % 25).cast("int")).join(F.broadcast(n), "n_nationkey")  # 25 rows
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, F.concat(F.lit("fresh "), "nation", F.lit(" "), "p_partkey")).when(k == 1, F.concat(F.lit("x"), "p_partkey", F.lit("/"), "nation")).when(k == 2, F.concat(F.lit("Green q"), "p_partkey")).when(k == 3, F.concat(F.lit("("), "p_size", F.lit(")"))).otherwise(F.concat("nation", F.lit("-"), F.col("p_partkey") % 100))
    return p.select(name.alias("name"))


_NAMES_SQL = "names AS (SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN 'fresh ' || lower(n_name) || ' ' || p_partkey WHEN 1 THEN 'x' || p_partkey || '/' || lower(n_name) WHEN 2 THEN 'Green q' || p_partkey WHEN 3 THEN '(' || p_size || ')' ELSE lower(n_name) || '-' || p_partkey % 100 END AS name FROM part JOIN nation ON n_nationkey = p_partkey % 25)"


def token_match(spark: SparkSession, d: str) -> DataFrame:
    crops = table(spark, d, "nation").select(F.col("n_nationkey").alias("ordinal"), F.concat(F.lit("c"), "n_nationkey").alias("crop_id"), F.array(F.lower("n_name"), F.concat(F.lower("n_name"), F.lit(" fresh crop")), F.regexp_replace(F.lower("n_name"), "[^a-z0-9]", "")).alias("aliases"))
    return resolve.token_match(_part_names(spark, d), crops)


_STOPS = ", ".join(f"'{w}'" for w in resolve.STOP_WORDS)
TOKEN_MATCH = rf"""
WITH {_NAMES_SQL},
c AS (SELECT n_nationkey AS o, unnest([lower(n_name), lower(n_name) || ' fresh crop', regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g')]) AS alias FROM nation),
f AS (SELECT name, unnest(list_concat([lower(name)], list_transform(string_split_regex(lower(name), '[/(),\-]'), lambda x: trim(x)))) AS form FROM names),
cands AS (SELECT name, form AS cand FROM f WHERE form <> '' UNION SELECT name, regexp_replace(form, '[^a-z0-9]', '', 'g') FROM f WHERE regexp_replace(form, '[^a-z0-9]', '', 'g') <> ''),
w AS (SELECT name, trim(regexp_replace(name, '[()/\-]', ' ', 'g')) AS clean FROM names),
needles AS (SELECT name, clean AS needle FROM w WHERE clean <> '' UNION SELECT name, unnest(list_filter(string_split_regex(clean, '\s+'), lambda x: len(x) >= 3 AND x NOT IN ({_STOPS}))) FROM w),
h AS (SELECT name, o FROM cands JOIN c ON alias = cand UNION ALL SELECT name, o FROM needles JOIN c ON contains(alias, needle)),
b AS (SELECT name, min(o) AS o FROM h GROUP BY 1)
SELECT names.name, 'c' || b.o AS crop_id FROM names LEFT JOIN b USING (name)"""


def crop_ids(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    lookup = n.select(F.format_string("%03d", "n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 4 != 0, F.concat(F.lit("m"), "n_nationkey")).otherwise("").alias("crop_master_id"), F.array(F.lower("n_name"), F.concat(F.lower("n_name"), F.lit(" grain"))).alias("aliases"))
    p = table(spark, d, "part").select(F.concat(F.when(F.col("p_partkey") % 3 == 0, F.lit(" Nation_")).when(F.col("p_partkey") % 3 == 1, F.lit("tion_")).otherwise(F.lit("_")), (F.col("p_partkey") % 40).cast("string"), F.when(F.col("p_partkey") % 7 == 0, F.lit(" gr")).otherwise(F.lit(" "))).alias("name"))
    return resolve.crop_master_id(p, lookup)


CROP_IDS = """
WITH l AS (SELECT printf('%03d', n_nationkey) AS id, 'm' || n_nationkey AS m, unnest([lower(n_name), lower(n_name) || ' grain']) AS alias FROM nation WHERE n_nationkey % 4 <> 0),
n AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN ' Nation_' WHEN 1 THEN 'tion_' ELSE '_' END || p_partkey % 40 || CASE WHEN p_partkey % 7 = 0 THEN ' gr' ELSE ' ' END AS name FROM part),
h AS (SELECT name, CASE WHEN alias = lower(trim(name)) THEN 1 ELSE 2 END AS rank, id, m FROM n JOIN l ON contains(alias, lower(trim(name)))),
b AS (SELECT name, min(rank || id || '|' || m) AS b FROM h GROUP BY 1)
SELECT n.name, split_part(b, '|', 2) AS crop_master_id, CAST(b[1] AS INTEGER) AS rank FROM n LEFT JOIN b USING (name)"""


def _fuzzy(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    lookup = n.select(F.format_string("%03d", "n_nationkey").alias("id"), F.lower("n_name").alias("canonical_name"), F.array(F.concat(F.lower("n_name"), F.lit(" (local)"))).alias("aliases"))
    return resolve.fuzzy_best(_part_names(spark, d), lookup)


def fuzzy_best(spark: SparkSession, d: str) -> DataFrame:
    return _fuzzy(spark, d)


def review_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """Guesses of the matcher as rows of the review queue."""
    best = _fuzzy(spark, d).withColumn("records", F.length("name"))
    out = review.suggestions(best, F.lit("2026-10-31").cast("timestamp"), "backfill")
    return out.select("key", "type", "status", "title", "details", "records_seen", F.col("suggestion.by").alias("by"), (F.col("suggestion.score") == F.round("suggestion.score", 3)).alias("rounded"))


REVIEW_SUGGESTIONS = f"""
WITH {_NAMES_SQL} SELECT 'unmapped_commodity|' || name AS key, 'unmapped_commodity' AS type, 'open' AS status, 'Crop name not matched: ' || name AS title, '{{"commodity_name":"' || name || '"}}' AS details, length(name) AS records_seen, 'backfill' AS by, true AS rounded FROM names"""


def star_dim(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.lit("tpch").alias("source_system"), F.col("c_nationkey").cast("string").alias("state"), F.lower("c_mktsegment").alias("market_name"), F.lit(None).cast("string").alias("commodity_name"), F.when(F.col("c_custkey") % 2 == 0, "even").alias("variety"))
    return star.with_key(c).distinct()


STAR_DIM = """
SELECT DISTINCT 'tpch' AS source_system, CAST(c_nationkey AS VARCHAR) AS state, lower(c_mktsegment) AS market_name, NULL::VARCHAR AS commodity_name, CASE WHEN c_custkey % 2 = 0 THEN 'even' END AS variety,
       md5('tpch||' || c_nationkey || '||' || lower(c_mktsegment) || '||||' || CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE '' END) AS market_commodity_id FROM customer"""


def star_fact(spark: SparkSession, d: str) -> DataFrame:
    dim = star_dim(spark, d).select("state", "variety", "market_commodity_id", "market_name")
    facts = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("state"), F.lower("c_mktsegment").alias("market_name"), F.when(F.col("c_custkey") % 2 == 0, "even").alias("variety"))
    return star.attach_ids(facts, dim, ["state", "market_name", "variety"], "market_commodity_id").select("c_custkey", "market_commodity_id")


STAR_FACT = """
SELECT c_custkey, md5('tpch||' || c_nationkey || '||' || lower(c_mktsegment) || '||||' || CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE '' END) AS market_commodity_id FROM customer"""


def semi_join(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(ids, "o_custkey", "left_semi").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


SEMI_JOIN = "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1"


def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("label", F.when(F.col("p_partkey") % 2 == 0, "new").otherwise("old"))
    return repair.overlap_pairs(p, ["p_brand", "p_size"], "label", "new", "old", "p_partkey")


OVERLAP_PAIRS = """
SELECT min(p_partkey) FILTER (p_partkey % 2 = 0) AS keep_id, min(p_partkey) FILTER (p_partkey % 2 = 1) AS old_id FROM part GROUP BY p_brand, p_size
HAVING count(*) FILTER (p_partkey % 2 = 0) > 0 AND count(*) FILTER (p_partkey % 2 = 1) > 0"""

QUERIES = {k: (globals()[k], globals().get(k.upper())) for k in "tier_resolve offline_resolve new_markets alias_join token_match crop_ids fuzzy_best review_suggestions star_dim star_fact semi_join overlap_pairs".split()}
