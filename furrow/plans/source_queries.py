"""Queries over sources, plans, layouts and harmonisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.data import load
from furrow.functions import scalars as X
from furrow.operators import audit as A
from furrow.operators import normalise as N
from furrow.operators import star
from furrow.plans.tables import table
from furrow.session import fresh_path
from furrow.sources import html_tables, landed
from furrow.sources.specs import SPECS


def harmonise_union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), X.first_truthy(F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name")), F.col("c_mktsegment")).alias("label"), X.first_truthy_number(F.when(F.col("c_custkey") % 3 == 0, 0.0).otherwise(F.col("c_acctbal")), F.lit(-1.0)).alias("balance"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


HARMONISE_UNION = """
SELECT 'customer' AS kind, c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS label, CASE WHEN c_custkey % 3 = 0 OR c_acctbal = 0 THEN -1.0 ELSE c_acctbal END AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier"""


#: The feeds in order, and the columns that each gives for records made from orders.
_FEEDS = list(SPECS)
_GIVEN = {name: [t for t in ("date", "market", "commodity", "variety", "min", "max", "modal") if SPECS[name].get(t)] for name in _FEEDS}


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Raw records of all feeds made from orders, each with the last of the fields that the feed may use, and an empty one before it."""
    o = table(spark, d, "orders")
    text = lambda c: F.col(c).cast("string")
    price = F.concat(F.lit("Rs "), F.round("o_totalprice").cast("bigint").cast("string"), F.lit(" / Quintal"))
    value = {"market": F.concat(F.lit(" Market "), text("o_custkey")), "date": F.date_format("o_orderdate", "dd/MM/yyyy"), "commodity": text("o_orderpriority"), "variety": text("o_orderstatus"), "min": price, "max": price, "modal": price}
    record = None
    for k, name in enumerate(_FEEDS):
        pairs = []
        for t in _GIVEN[name]:
            fields = SPECS[name][t]
            pairs += [x for f in fields[:-1][:1] if fields[-1] != f for x in (F.lit(f), F.lit(""))] if t == "market" else []
            pairs += [F.lit(fields[-1 if t == "market" else 0]), value[t]]
        if SPECS[name].get("state"):
            pairs += [F.lit(SPECS[name]["state"][0]), F.lit("Odisha")]
        c, m = F.col("o_orderkey") % len(_FEEDS) == k, F.create_map(*pairs)
        record = F.when(c, m) if record is None else record.when(c, m)
    source = F.element_at(F.array(*map(F.lit, _FEEDS)), (F.col("o_orderkey") % len(_FEEDS) + 1).cast("int"))
    return o.select(source.alias("source"), F.col("o_orderkey").alias("ordinal"), record.alias("record"))


def _by_feed(of) -> str:
    return "CASE o_orderkey % " + str(len(_FEEDS)) + " " + " ".join(f"WHEN {k} THEN {of(n)}" for k, n in enumerate(_FEEDS)) + " END"


def _given(target: str, value: str) -> str:
    return _by_feed(lambda n: value if target in _GIVEN[n] else "NULL")


_NORMAL_SQL = f"""n AS (SELECT {_by_feed(lambda n: f"'{n}'")} AS source, o_orderkey AS ordinal, {_by_feed(lambda n: "'" + SPECS[n]["system"] + "'")} AS source_system,
  {_by_feed(lambda n: "'odisha'" if SPECS[n].get("state") else "'" + n.replace("_", " ") + "'")} AS state, 'market ' || o_custkey AS market_name, lower(o_orderpriority) AS commodity_name, {_given("variety", "lower(o_orderstatus)")} AS variety,
  strftime(o_orderdate, '%Y-%m-%d') AS day, {_given("min", "round(o_totalprice)")} AS min_price, {_given("max", "round(o_totalprice)")} AS max_price, {_given("modal", "round(o_totalprice)")} AS modal_price, {_by_feed(lambda n: "'" + landed.SOURCES[n]["method"] + "'")} AS method FROM orders)"""


def normalise(spark: SparkSession, d: str) -> DataFrame:
    n = N.normalise(_records(spark, d))
    return n.select("source", "ordinal", "source_system", "state", "market_name", "commodity_name", "variety", F.date_format("date", "yyyy-MM-dd").alias("day"), "min_price", "max_price", "modal_price", "method")


NORMALISE = f"WITH {_NORMAL_SQL} SELECT * FROM n"


def guard(spark: SparkSession, d: str) -> DataFrame:
    """What the guard lets through and what goes to quarantine, with the reason."""
    now = F.lit("1997-06-17").cast("timestamp")
    records = _records(spark, d).withColumn("record", F.when(F.col("ordinal") % 9 == 0, F.map_concat(F.map_filter("record", lambda k, _: ~k.isin(*(s["date"][0] for s in SPECS.values()))), F.create_map(F.element_at(F.array(*(F.lit(SPECS[n]["date"][0]) for n in _FEEDS)), (F.col("ordinal") % len(_FEEDS) + 1).cast("int")), F.lit("soon")))).otherwise(F.col("record")))
    rows = N.normalise(records)
    kept = N.guard(rows, now).select("source", "ordinal", F.lit("kept").alias("what"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(N.quarantine(rows, now).select("source", "ordinal", F.lit("rejected").alias("what"), "reason"))


GUARD = f"""
WITH {_NORMAL_SQL}, x AS (SELECT *, ordinal % 9 = 0 AS bad, ordinal % 9 <> 0 AND day > '1997-06-17' AS late FROM n)
SELECT source, ordinal, 'kept' AS what, NULL AS reason FROM x WHERE NOT late UNION ALL SELECT source, ordinal, 'rejected', CASE WHEN late THEN 'future date' ELSE 'date: soon' END FROM x WHERE late OR bad"""


def quarantine_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = N.normalise(_records(spark, d))
    return N.quarantine_summary(N.quarantine(rows, F.lit("1997-06-17").cast("timestamp")))


QUARANTINE_SUMMARY = f"""
WITH {_NORMAL_SQL} SELECT source, count(*) AS rejected, array_to_string(list_resize(list_transform(range(count(*)), lambda i: 'future date'), least(5, count(*))), '; ') AS samples FROM n WHERE day > '1997-06-17' GROUP BY 1"""


def unknown_sources(spark: SparkSession, d: str) -> DataFrame:
    return N.unknown_sources(_records(spark, d).withColumn("source", F.when(F.col("ordinal") % 4 == 0, F.concat(F.lit("new "), "source")).otherwise(F.col("source"))))


UNKNOWN_SOURCES = f"WITH {_NORMAL_SQL} SELECT 'new ' || source AS source, count(*) AS count FROM n WHERE ordinal % 4 = 0 GROUP BY 1"


def star_split(spark: SparkSession, d: str) -> DataFrame:
    """The rows of both tables, each key's last ones; harmonised once."""
    rows = N.normalise(_records(spark, d)).withColumn("market_id", F.lit(None).cast("string")).withColumn("commodity_alias_lookup_id", F.lit(None).cast("string"))
    dim, fact = star.split(star.last_of_day(rows))
    none = F.lit(None).cast("double")
    dims = dim.groupBy("market_commodity_id", *star.DIM_KEY).agg(F.max("ordinal").alias("ordinal")).select(F.lit("dim").alias("t"), "market_commodity_id", *star.DIM_KEY, F.lit(None).cast("string").alias("day"), none.alias("min_price"), none.alias("modal_price"), "ordinal")
    facts = fact.select(F.lit("fact").alias("t"), "market_commodity_id", *(F.lit(None).cast("string").alias(c) for c in star.DIM_KEY), F.date_format("date", "yyyy-MM-dd").alias("day"), "min_price", "modal_price", "ordinal")
    return dims.union(facts)


STAR_SPLIT = f"""
WITH {_NORMAL_SQL}, k AS (SELECT *, md5(source_system || '||' || state || '||' || market_name || '||' || commodity_name || '||' || coalesce(variety, '')) AS id FROM n),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY ordinal DESC) AS r FROM k) WHERE r = 1)
SELECT 'dim' AS t, id AS market_commodity_id, source_system, state, market_name, commodity_name, variety, NULL AS day, NULL::DOUBLE AS min_price, NULL::DOUBLE AS modal_price, max(ordinal) AS ordinal FROM k GROUP BY ALL
UNION ALL SELECT 'fact', id, NULL, NULL, NULL, NULL, NULL, day, min_price, modal_price, ordinal FROM f"""


def strip_nulls(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    return star.without_nulls(c)


STRIP_NULLS = """SELECT CASE WHEN c_custkey % 2 = 0 THEN '{"c_custkey":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' ELSE '{"c_custkey":' || c_custkey || '}' END AS document FROM customer"""


def request_plan(spark: SparkSession, d: str) -> DataFrame:
    return landed.request_plan(table(spark, d, "nation").select("n_nationkey"), table(spark, d, "region").select("r_regionkey"))


REQUEST_PLAN = "SELECT n_nationkey, r_regionkey FROM nation CROSS JOIN region"


def page_plan(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("partition")).agg(F.count("*").alias("total"))
    return landed.page_plan(totals, 700, 1500)


PAGE_PLAN = """
WITH t AS (SELECT o_orderpriority AS partition, count(*) AS total FROM orders GROUP BY 1), p AS (SELECT partition, unnest(range(0, total, 700)) AS o FROM t)
SELECT partition, o::BIGINT AS "offset", least(700, 1500 - o)::BIGINT AS size FROM p WHERE o < 1500"""


def date_spine(spark: SparkSession, d: str) -> DataFrame:
    """Records by day; the days of every fifth date gave none."""
    files = table(spark, d, "events").select(F.when(F.dayofmonth("ts") % 5 != 0, F.to_date("ts")).alias("day"))
    out = landed.landed_days(landed.date_spine(files, "day"), files)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "records", "landed")


DATE_SPINE = """
WITH f AS (SELECT ts::DATE AS day, count(*) AS n FROM events WHERE day(ts) % 5 <> 0 GROUP BY 1), s AS (SELECT unnest(generate_series((SELECT min(day) FROM f), (SELECT max(day) FROM f), INTERVAL 1 DAY))::DATE AS day)
SELECT strftime(s.day, '%Y-%m-%d') AS day, coalesce(n, 0) AS records, n IS NOT NULL AS landed FROM s LEFT JOIN f USING (day)"""


def request_ranges(spark: SparkSession, d: str) -> DataFrame:
    """What a request asks for: days and milliseconds from whatever is given, else the usual range."""
    o = table(spark, d, "orders")
    k, now = F.col("o_orderkey") % 3, F.lit("1998-12-01")
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
    span = landed.epoch_range(text, F.lit(None).cast("string"), now.cast("timestamp"), 30)
    days = landed.day_range(F.when(k == 0, F.to_date("o_orderdate")), F.lit(None).cast("date"), now.cast("date"))
    return o.select("o_orderkey", span["start"].alias("start"), span["end"].alias("end"), F.date_format(days["first"], "yyyy-MM-dd").alias("first"), F.date_format(days["last"], "yyyy-MM-dd").alias("last"))


REQUEST_RANGES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN epoch_ms(TIMESTAMP '1998-11-01') ELSE epoch_ms(date_trunc('day', o_orderdate)) END AS start, epoch_ms(TIMESTAMP '1998-12-01') AS "end",
       CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '1998-11-30' END AS first, '1998-12-01' AS last FROM orders"""


def absent_partitions(spark: SparkSession, d: str) -> DataFrame:
    """States that the national feed knows and no customer is from: customers' nations stand for every other state."""
    known = landed.known_partitions(spark).withColumn("n", F.row_number().over(Window.orderBy("partition")) - 1)  # a fixed, short list
    found = table(spark, d, "customer").select((F.col("c_nationkey") * 2).alias("n"))
    return landed.absent_partitions(known, found, "n").select("partition")


_PARTITIONS = ", ".join(f"('{x}')" for x in load("words")["partitions"])
ABSENT_PARTITIONS = f"SELECT partition FROM (SELECT partition, row_number() OVER (ORDER BY partition) - 1 AS n FROM (VALUES {_PARTITIONS}) t(partition)) WHERE n NOT IN (SELECT c_nationkey * 2 FROM customer)"


def page_chain(spark: SparkSession, d: str) -> DataFrame:
    """Pages up to the first without a next link: an event's page is its place on its user's day."""
    w = Window.partitionBy("source").orderBy("event_id")
    e = table(spark, d, "events").select(F.concat_ws(":", F.col("user_id"), F.to_date("ts")).alias("source"), "event_id", (F.col("event_id") % 3 != 0).alias("has_next"))
    return landed.chained_pages(e.withColumn("page", F.row_number().over(w))).select("source", "page", "event_id")


PAGE_CHAIN = """
WITH p AS (SELECT user_id || ':' || ts::DATE AS source, event_id, event_id % 3 <> 0 AS has_next, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) AS page FROM events)
SELECT source, page::INTEGER AS page, event_id FROM p WHERE NOT EXISTS (SELECT 1 FROM p x WHERE x.source = p.source AND x.page < p.page AND NOT x.has_next)"""


def json_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """Payloads written as a checkpoint and read again; one source failed, one source's data is a text of JSON."""
    e = table(spark, d, "events")
    ok = F.col("event_type") != "click"
    record = F.when(ok, F.create_map(F.lit("id"), F.col("event_id").cast("string"), F.lit("v"), F.col("value").cast("string")))
    rows = e.select(F.col("event_type").alias("source"), ok.alias("success"), F.when(~ok, "timeout").alias("error"), F.lit(None).cast("string").alias("details"), F.col("event_id").alias("ordinal"), record.alias("record"))
    path = fresh_path(spark, "checkpoint")
    landed.write_checkpoint(rows, path)
    again = landed.read_checkpoint(spark, path)
    texts = again.where("success").groupBy("source").agg(F.to_json(landed.records_in_order()).alias("data"))
    texts = texts.select(F.to_json(F.create_map(F.concat(F.lit("text "), "source"), F.struct(F.lit(True).alias("success"), "data"))).alias("value"))
    every = again.unionByName(landed.payload_records(texts))
    return every.select("source", "success", "error", F.col("ordinal").cast("bigint").alias("ordinal"), F.col("record")["id"].alias("id"))


JSON_CHECKPOINT = """
WITH o AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS n FROM events WHERE event_type <> 'click')
SELECT event_type AS source, true AS success, NULL AS error, n AS ordinal, CAST(event_id AS VARCHAR) AS id FROM o UNION ALL SELECT 'text ' || event_type, true, NULL, n, CAST(event_id AS VARCHAR) FROM o
UNION ALL SELECT 'click', false, 'timeout', NULL, NULL WHERE EXISTS (SELECT 1 FROM events WHERE event_type = 'click')"""


def csv_names(spark: SparkSession, d: str) -> DataFrame:
    """A CSV of names written and read again: blank names and placeholders go."""
    p = table(spark, d, "part")
    name = F.when(F.col("p_partkey") % 5 == 0, F.lit(" ")).when(F.col("p_partkey") % 5 == 1, F.lit("(No commodity_name)")).otherwise(F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"')))
    path = fresh_path(spark, "names")
    landed.write_csv(p.select(name.alias("commodity_name"), "p_partkey").withColumn("notes", F.when(F.col("p_partkey") % 2 == 0, "a,b")), path)
    return landed.read_names_csv(spark, path, "commodity_name string, p_partkey bigint, notes string")


CSV_NAMES = """SELECT p_name || ', "' || p_brand || '"' AS commodity_name, p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a,b' END AS notes FROM part WHERE p_partkey % 5 > 1"""


def sheet_import(spark: SparkSession, d: str) -> DataFrame:
    """A sheet whose columns are found by words in their headers, or by their place."""
    p = table(spark, d, "part")
    path = fresh_path(spark, "sheet")
    landed.write_csv(p.select(F.col("p_partkey").cast("string").alias("No."), F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("Market Name (full)"), F.when(F.col("p_size") > 25, " ").otherwise(F.col("p_brand")).alias("col3")), path)
    return landed.read_sheet(spark, path, {"name": ("market",), "state": ("state",), "row": ("no.",)}, {"name": 0, "state": 2, "row": 1})


SHEET_IMPORT = "SELECT trim(p_name) AS name, CASE WHEN p_size <= 25 THEN p_brand END AS state, CAST(p_partkey AS VARCHAR) AS row FROM part"


def report_copy(spark: SparkSession, d: str) -> DataFrame:
    """An audit's report as JSON, a checked copy of a table, and its source's label set."""
    p = table(spark, d, "part")
    report, copy = fresh_path(spark, "report"), fresh_path(spark, "copy")
    landed.write_report(A.outliers(p, "size", "p_size", 40), report)
    n = landed.copy_table(spark, f"{d}/part.parquet", copy)
    same = landed.override_source(spark.read.parquet(copy), "copied").groupBy("source_system").agg(F.count("*").alias("value"))
    found = spark.read.schema("section string, metric string, value bigint, total bigint").json(report)
    return found.unionByName(same.select(F.lit("copy").alias("section"), F.col("source_system").alias("metric"), "value", F.lit(n).cast("bigint").alias("total")))


REPORT_COPY = """
SELECT 'size' AS section, unnest(['below_zero', 'above_most']) AS metric, unnest([count(*) FILTER (p_size < 0), count(*) FILTER (p_size > 40)]) AS value, count(*) AS total FROM part
UNION ALL SELECT 'copy', 'copied', count(*), count(*) FROM part"""


def gather_sources(spark: SparkSession, d: str) -> DataFrame:
    frames = {"c": table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), "s": table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))}
    return landed.gather(frames)


GATHER_SOURCES = "SELECT c_custkey AS id, c_mktsegment AS segment, 'c' AS source FROM customer UNION ALL SELECT s_suppkey, NULL, 's' FROM supplier"


def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Nested documents of customers (latitude, longitude, day -> order -> items), flattened again."""
    line = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("items"))
    o = table(spark, d, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"))
    o = o.select(F.concat(F.lit("loc"), "o_custkey").alias("loc"), F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.concat(F.lit("u"), "o_orderkey").alias("k"), "items")
    days = o.groupBy("loc", "o_custkey", "day").agg(F.map_from_entries(F.collect_list(F.struct("k", "items"))).alias("crops"))
    body = days.groupBy("loc", "o_custkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("day", "crops")))).alias("days"))
    doc = F.concat(F.lit('{"'), "loc", F.lit('":{"latitude":'), (F.col("o_custkey") / 2.0).cast("string"), F.lit(',"longitude":1.5,'), F.expr("substring(days, 2)"), F.lit("}"))
    flat = landed.flatten_locations(body.select(doc.alias("doc")), "doc")
    return flat.select("location", "latitude", "longitude", "day", "crop_key", F.col("pos").cast("int").alias("pos"), F.expr("try_variant_get(item, '$.l_quantity', 'double')").alias("quantity"))


JSON_FLATTEN = """
SELECT 'loc' || o_custkey AS location, o_custkey / 2.0::DOUBLE AS latitude, 1.5::DOUBLE AS longitude, strftime(o_orderdate, '%Y-%m-%d') AS day, 'u' || o_orderkey AS crop_key,
       (row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_quantity) - 1)::INTEGER AS pos, l_quantity AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def payload_status(spark: SparkSession, d: str) -> DataFrame:
    """Status rows of payloads: success flag, records and error of each source (events by type, one type failed)."""
    e = table(spark, d, "events").select(F.col("event_type").alias("source"), (F.col("event_type") != "click").alias("success"), F.when(F.col("event_type") == "click", "timeout").alias("error"), F.lit(None).cast("string").alias("details"), F.col("event_id").alias("ordinal"), F.when(F.col("event_type") != "click", F.create_map(F.lit("v"), F.col("value").cast("string"))).alias("record"))
    return landed.source_status(e).join(landed.successful(e).groupBy("source").agg(F.count("*").alias("usable")), "source", "left")


PAYLOAD_STATUS = """
SELECT event_type AS source, event_type <> 'click' AS success, CASE WHEN event_type = 'click' THEN 'timeout' END AS error, NULL::VARCHAR AS details, count(*) FILTER (event_type <> 'click') AS records,
       nullif(count(*) FILTER (event_type <> 'click'), 0) AS usable FROM events GROUP BY event_type"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each brand with a table of its parts."""
    p = table(spark, d, "part")
    row = F.concat(F.lit("<tr><td>"), F.col("p_partkey").cast("string"), F.lit("</td><td>"), X.html_escape(F.concat(F.lit(" <"), F.col("p_name"), F.lit("> & "))), F.lit("</td><td>x"), F.when(F.col("p_partkey") % 10 == 0, F.lit("</td><td>odd")).otherwise(""), F.lit("</td></tr>"))
    body = p.select("p_brand", F.struct("p_partkey", row.alias("r")).alias("s")).groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["r"]), "").alias("b"))
    return body.select(F.col("p_brand").alias("page_id"), F.concat(F.lit("<html><span>Group "), "p_brand", F.lit("</span><table><tr><th>Key</th><th>Name</th><th>Telegram</th></tr>"), "b", F.lit("</table></html>")).alias("html"))


def html_table(spark: SparkSession, d: str) -> DataFrame:
    rows = html_tables.read_rows(_pages(spark, d))
    return html_tables.header_records(rows, drop=("Telegram",)).select("page_id", "caption", F.col("record")["Key"].alias("key"), F.col("record")["Name"].alias("name"), F.size("record").alias("columns"))


HTML_TABLE = "SELECT p_brand AS page_id, 'Group ' || p_brand AS caption, CAST(p_partkey AS VARCHAR) AS key, '<' || p_name || '> &' AS name, 2 AS columns FROM part WHERE p_partkey % 10 <> 0"


def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one cell are dates that hold for the rows of seven cells below them."""
    p = table(spark, d, "part")
    cells = F.when(F.col("p_partkey") % 5 == 0, F.array(F.concat(F.lit("day "), F.col("p_partkey").cast("string")))).when(F.col("p_partkey") % 5 == 3, F.array_repeat(F.lit("x"), 4)).otherwise(F.array_repeat(F.col("p_partkey").cast("string"), 7))
    rows = p.select(F.col("p_brand").alias("page_id"), F.lit(0).alias("table"), F.col("p_partkey").alias("row"), cells.alias("cells"))
    return html_tables.dated_rows(rows).select("page_id", "row", "date", F.col("cells")[6].alias("last_cell"))


FORWARD_FILL = """
WITH t AS (SELECT p_brand, p_partkey, last_value(CASE WHEN p_partkey % 5 = 0 THEN 'day ' || p_partkey END IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS date FROM part)
SELECT p_brand AS page_id, p_partkey AS row, date, CAST(p_partkey AS VARCHAR) AS last_cell FROM t WHERE p_partkey % 5 NOT IN (0, 3)"""


def grid_rows(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    base = F.array(*(F.concat(F.lit(" 0"), F.col("p_partkey").cast("string")) for _ in range(9)))
    cells = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.array(F.lit("group")), base)).when(F.col("p_partkey") % 4 == 1, base).otherwise(F.array(F.lit("note")))
    rows = p.select("p_partkey", cells.alias("cells"), (F.col("p_partkey") % 12 == 0).alias("link"))
    return html_tables.grid_rows(rows).select("p_partkey", F.array_join("cells", ",").alias("cells"))


GRID_ROWS = "SELECT p_partkey, array_to_string(list_transform(range(9), lambda i: CAST(p_partkey AS VARCHAR)), ',') AS cells FROM part WHERE p_partkey % 4 <= 1 AND p_partkey % 12 <> 0"


def geocodes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    markets = n.select(F.col("n_regionkey").cast("string").alias("state"), F.col("n_name").alias("name"))
    own = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.concat(F.lit("other "), "n_name"))
    geo = n.select(F.col("n_regionkey").cast("string").alias("state"), own.alias("name"), F.lit("d").alias("district"), F.lit("1").alias("postcode"), F.col("n_nationkey").cast("double").alias("lon"), F.lit(2.0).alias("lat"))
    out = landed.with_geocodes(markets, geo)
    return out.select("state", "name", "district", "postcode", F.col("location.type").alias("type"), F.col("location.coordinates")[0].alias("lon"))


GEOCODES = "SELECT CAST(n_regionkey AS VARCHAR) AS state, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'd' END AS district, CASE WHEN n_nationkey % 2 = 0 THEN '1' END AS postcode, CASE WHEN n_nationkey % 2 = 0 THEN 'Point' END AS type, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey::DOUBLE END AS lon FROM nation"

QUERIES = {k: (globals()[k], globals()[k.upper()]) for k in "harmonise_union normalise guard quarantine_summary unknown_sources star_split strip_nulls request_plan page_plan date_spine request_ranges absent_partitions page_chain json_checkpoint csv_names sheet_import report_copy gather_sources json_flatten payload_status html_table forward_fill grid_rows geocodes".split()}
