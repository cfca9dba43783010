"""Queries over scalar functions: dates, prices, names, keys, formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import fuzzy
from furrow.functions import scalars as X
from furrow.operators import review
from furrow.plans.tables import table

_NOW = "1997-06-17"


def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    """Order dates in the forms that feeds use: ISO, numbers, month names, ordinals, short years, with a time, without a day."""
    o = table(spark, d, "orders")
    day = F.col("o_orderdate")
    forms = [
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(day, "yyyyMMdd"),
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "d-M-yyyy"),
        F.date_format(day, "d MMM yyyy"),
        F.lit("not a date"),
        F.date_format(day, "MMMM d, yyyy"),
        F.date_format(day, "dd-MMM-yy"),
        F.date_format(day, "d/M/yy"),
        F.date_format(day, "MMM yyyy"),
        F.date_format(day, "d'th' MMMM, yyyy"),
        F.concat(F.lit(" "), F.date_format(day, "dd.MM.yyyy"), F.lit(" 06:30 PM ")),
        F.date_format(day, "EEE, d MMM yyyy 7:05:09"),
    ]
    text = F.element_at(F.array(*forms), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    return o.select("o_orderkey", F.date_format(X.parse_date(text, F.lit(_NOW).cast("date")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


PARSE_DATES = f"""
SELECT o_orderkey, CASE o_orderkey % 13 WHEN 5 THEN NULL
    WHEN 9 THEN strftime(make_date(year(o_orderdate), month(o_orderdate), least(day(DATE '{_NOW}'), day(last_day(o_orderdate)))), '%Y-%m-%d') || ' 00:00:00'
    ELSE strftime(o_orderdate, '%Y-%m-%d') || CASE o_orderkey % 13 WHEN 11 THEN ' 18:30:00' WHEN 12 THEN ' 07:05:09' ELSE ' 00:00:00' END END AS parsed FROM orders"""


def parse_prices(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    price = F.format_string("%.2f", "p_retailprice")
    k = F.col("p_partkey") % 5
    text = F.when(k == 0, F.concat(F.lit("Rs "), price, F.lit(" / Quintal"))).when(k == 1, F.concat(F.lit("₹"), price)).when(k == 2, F.concat(F.lit("Rs. "), price)).when(k == 3, F.lit("12-15")).otherwise(F.lit("N/A"))
    return p.select("p_partkey", X.to_price(text).alias("strict_price"), X.to_price(text, strict=False).alias("compat_price"))


PARSE_PRICES = """
SELECT p_partkey, CASE WHEN p_partkey % 5 <= 2 THEN round(p_retailprice, 2) END AS strict_price,
       CASE WHEN p_partkey % 5 <= 1 THEN round(p_retailprice, 2) WHEN p_partkey % 5 = 2 THEN TRY_CAST('.' || printf('%.2f', p_retailprice) AS DOUBLE) END AS compat_price
FROM part"""


def future_guard(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("day", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")))
    now = F.lit(_NOW).cast("timestamp")
    return o.groupBy(X.is_future(F.col("day"), now).alias("is_future")).agg(F.count("*").alias("n"))


FUTURE_GUARD = f"SELECT coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) > DATE '{_NOW}' END, false) AS is_future, count(*) AS n FROM orders GROUP BY 1"


def swap_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.date_format(X.swap_day_month(F.col("o_orderdate")), "yyyy-MM-dd").alias("swapped"))


SWAP_DATES = """
SELECT o_orderkey, strftime(CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS swapped
FROM orders"""


def names_lower(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    dirty = F.when(F.col("p_partkey") % 4 == 0, F.lit("")).when(F.col("p_partkey") % 4 == 1, F.lit("   ")).otherwise(F.concat(F.lit("   "), F.upper("p_name"), F.lit("  x \t")))
    return p.select("p_partkey", X.lower_strip(dirty).alias("lowered"), X.collapse(dirty).alias("collapsed"), X.blank_to_null(dirty).alias("text"))


NAMES_LOWER = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lower(p_name) || '  x' END AS lowered,
       CASE WHEN p_partkey % 4 <= 1 THEN '' ELSE lower(regexp_replace(p_name, '\\s+', ' ', 'g')) || ' x' END AS collapsed,
       CASE WHEN p_partkey % 4 <= 1 THEN NULL ELSE upper(p_name) || '  x' END AS text
FROM part"""


def title_names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    raw = F.concat(F.upper("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" apmc, / new yard /  new yard")).otherwise(F.lit(".")))
    n = X.market_names(raw)
    return p.select("p_partkey", n["name"].alias("name"), F.array_join(n["aliases"], "|").alias("aliases"))


TITLE_NAMES = """
WITH t AS (SELECT p_partkey, array_to_string(list_transform(string_split(trim(p_name), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN title || ' APMC,' ELSE title || '.' END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'New Yard' ELSE '' END AS aliases FROM t"""


def alias_lists(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", F.array_join(X.alias_list(F.concat_ws(", ", "p_brand", "p_type", F.lit(" "), F.upper("p_brand")), F.col("p_name")), "|").alias("aliases"))


ALIAS_LISTS = """
SELECT p_partkey, array_to_string(list_sort(list_distinct([lower(trim(p_brand)), lower(trim(p_type)), lower(trim(p_name))])), '|') AS aliases FROM part"""


def feed_dates(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", X.feed_date(text, F.lit(_NOW).cast("date")).alias("asked"), X.epoch_millis(text, F.lit(0).cast("bigint")).alias("millis"))


FEED_DATES = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN strftime(DATE '{_NOW}', '%d/%m/%Y') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS asked,
       CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE epoch_ms(date_trunc('day', o_orderdate)) END AS millis
FROM orders"""


def formats(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    sec = F.when(F.col("event_id") % 10 != 0, F.round("value", 1) * F.when(F.col("event_id") % 3 == 0, 10).otherwise(1))
    return e.select("event_id", X.duration_text(sec).alias("duration"), X.percent_text(F.col("event_id") % 4, F.col("event_id") % 5).alias("pct"), X.date_key(F.col("ts")).alias("day"), X.has_non_ascii(F.concat("event_type", F.when(F.col("event_id") % 2 == 0, "é").otherwise("e"))).alias("non_ascii"))


FORMATS = """
WITH t AS (SELECT *, CASE WHEN event_id % 10 <> 0 THEN round(value, 1) * CASE WHEN event_id % 3 = 0 THEN 10 ELSE 1 END END AS sec FROM events)
SELECT event_id, CASE WHEN sec IS NULL THEN 'N/A' WHEN sec < 60 THEN printf('%.1fs', sec) ELSE CAST(floor(sec / 60) AS BIGINT) || 'm ' || printf('%.1fs', sec - floor(sec / 60) * 60) END AS duration,
       CASE WHEN event_id % 5 = 0 THEN 'N/A' ELSE printf('%.1f%%', 100.0 * (event_id % 4) / (event_id % 5)) END AS pct,
       strftime(ts, '%Y-%m-%d') AS day, event_id % 2 = 0 AS non_ascii
FROM t"""


def loose_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of a hand-kept sheet: blank and unreadable ones are null."""
    p = table(spark, d, "part")
    text = F.when(F.col("p_partkey") % 4 == 0, F.lit("  ")).when(F.col("p_partkey") % 4 == 1, F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.format_string("%.2f", "p_retailprice"), F.lit("\u00a0")))
    return p.select("p_partkey", X.lenient_number(text).alias("number"), X.number_or_text(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" 00"), F.col("p_size").cast("string"))).otherwise("x y")).alias("cell"))


LOOSE_NUMBERS = "SELECT p_partkey, CASE WHEN p_partkey % 4 >= 2 THEN round(p_retailprice, 2) END AS number, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'x y' END AS cell FROM part"


def candidate_forms(spark: SparkSession, d: str) -> DataFrame:
    """Normal form and the variants that the matchers try."""
    p = table(spark, d, "part")
    name = F.concat(F.lit(" "), F.upper("p_name"), F.lit("  ("), "p_brand", F.lit(")/"), "p_type", F.lit(" "))
    return p.select("p_partkey", fuzzy.normal_name(name).alias("normal"), F.array_join(fuzzy.candidate_names(name), "|").alias("forms"))


CANDIDATE_FORMS = """
WITH t AS (SELECT p_partkey, lower(p_name) || ' (' || lower(p_brand) || ')/' || lower(p_type) AS w, lower(p_name) AS n, lower(p_brand) AS b, lower(p_type) AS ty FROM part),
f AS (SELECT p_partkey, w, unnest([w, regexp_replace(w, '[^a-z0-9]', '', 'g'), n, regexp_replace(n, '[^a-z0-9]', '', 'g'), b, regexp_replace(b, '[^a-z0-9]', '', 'g'), ty, regexp_replace(ty, '[^a-z0-9]', '', 'g')]) AS form, unnest(range(8)) AS i FROM t),
u AS (SELECT p_partkey, w, form, min(i) AS i FROM f GROUP BY ALL)
SELECT p_partkey, w AS normal, string_agg(form, '|' ORDER BY i) AS forms FROM u GROUP BY 1, 2"""


def keys(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return c.select("c_custkey", X.composite_key(F.col("c_name"), seg, F.col("c_nationkey")).alias("key"), X.surrogate_key(F.col("c_name"), seg, F.col("c_nationkey")).alias("id"))


KEYS = """
WITH k AS (SELECT c_custkey, c_name || '||' || CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE '' END || '||' || c_nationkey AS key FROM customer)
SELECT c_custkey, key, md5(key) AS id FROM k"""


def state_names(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    raw = F.when(F.col("n_nationkey") % 5 == 0, F.lit(" Orissa ")).when(F.col("n_nationkey") % 5 == 1, F.lit("NCT of Delhi")).otherwise(F.col("n_name"))
    return n.select("n_nationkey", X.canonical_state(raw).alias("state"))


STATE_NAMES = "SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'odisha' WHEN 1 THEN 'delhi' ELSE lower(trim(n_name)) END AS state FROM nation"


def price_problems(spark: SparkSession, d: str) -> DataFrame:
    """Problems with small, fractional and very large prices in them."""
    x = table(spark, d, "lineitem")
    lo, hi = F.col("l_discount"), F.col("l_tax")
    modal = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") * 100000.3).otherwise(lo)
    return x.select("l_orderkey", "l_linenumber", F.array_join(review.price_problems(lo, hi, modal), "; ").alias("problems"))


PRICE_PROBLEMS = """
WITH t AS (SELECT l_orderkey, l_linenumber, l_discount AS lo, l_tax AS hi, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 100000.3::DOUBLE ELSE l_discount END AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws('; ',
       CASE WHEN lo <= 0 THEN printf('min price is %g', lo) END, CASE WHEN hi <= 0 THEN printf('max price is %g', hi) END, CASE WHEN m <= 0 THEN printf('modal price is %g', m) END,
       CASE WHEN lo > hi THEN printf('min price %g is above max price %g', lo, hi) END,
       CASE WHEN lo <= hi AND (m < lo OR m > hi) THEN printf('modal price %g is outside %g–%g', m, lo, hi) END) AS problems
FROM t"""

QUERIES = {
    "parse_dates": (parse_dates, PARSE_DATES),
    "parse_prices": (parse_prices, PARSE_PRICES),
    "future_guard": (future_guard, FUTURE_GUARD),
    "swap_dates": (swap_dates, SWAP_DATES),
    "names_lower": (names_lower, NAMES_LOWER),
    "title_names": (title_names, TITLE_NAMES),
    "alias_lists": (alias_lists, ALIAS_LISTS),
    "feed_dates": (feed_dates, FEED_DATES),
    "formats": (formats, FORMATS),
    "loose_numbers": (loose_numbers, LOOSE_NUMBERS),
    "candidate_forms": (candidate_forms, CANDIDATE_FORMS),
    "keys": (keys, KEYS),
    "state_names": (state_names, STATE_NAMES),
    "price_problems": (price_problems, PRICE_PROBLEMS),
}
