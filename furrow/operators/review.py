"""Run log and review queue from harmonised rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.functions import scalars as X
from furrow.sources.specs import NATIONAL

MAX_PRICE_ITEMS = 500
SAMPLES = 10


def price_problems(lo: Column, hi: Column, modal: Column) -> Column:
    """An array of problems of one row's prices: not above zero, min above max, modal outside a sound range."""
    text = X.number_text
    sign = [F.when(v <= 0, F.concat(F.lit(f"{n} price is "), text(v))) for n, v in (("min", lo), ("max", hi), ("modal", modal))]
    above = F.when(lo > hi, F.concat(F.lit("min price "), text(lo), F.lit(" is above max price "), text(hi)))
    outside = F.when((lo <= hi) & ((modal < lo) | (modal > hi)), F.concat(F.lit("modal price "), text(modal), F.lit(" is outside "), text(lo), F.lit("–"), text(hi)))
    return F.filter(F.array(*sign, above, outside), lambda p: p.isNotNull())


def first_samples(column: str, k: int = SAMPLES) -> Column:
    """The k smallest distinct values of a column, without collecting more than the distinct ones."""
    return F.slice(F.array_sort(F.collect_set(column)), 1, k)


def _named(rows: DataFrame) -> DataFrame:
    """rows with _source, _state, _market and _commodity: empty names are none."""
    unknown = F.lit("unknown")
    name = lambda c: F.when(X.truthy(F.col(c)), F.col(c))
    return rows.select("*", F.coalesce(name("source"), name("source_system"), unknown).alias("_source"), F.coalesce(name("state"), unknown).alias("_state"), name("market_name").alias("_market"), name("commodity_name").alias("_commodity"), name("source_system").alias("_system"))


def run_stats(rows: DataFrame) -> DataFrame:
    """By source and state: records, markets, crops without an alias entry, markets without an id."""
    unmapped = F.when(F.col("commodity_alias_lookup_id").isNull(), F.col("_commodity"))
    unknown = F.when(F.col("market_id").isNull(), F.col("_market"))
    return _named(rows).groupBy(F.col("_source").alias("source"), F.col("_state").alias("state")).agg(F.count("*").alias("records"), F.count_distinct("_market").alias("markets"), F.count_distinct(unmapped).alias("unmapped_commodities"), F.count_distinct(unknown).alias("unknown_markets"))


def run_documents(stats: DataFrame, status: DataFrame, run_id: str) -> DataFrame:
    """One row for each source: its status and an array of its states' numbers in order."""
    states = stats.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("state", "records", "markets", "unmapped_commodities", "unknown_markets"))).alias("states"), F.sum("records").alias("records_normalised"))
    error = F.when(~F.col("success"), X.error_text(F.col("error"), F.col("details"), 1000))
    return status.join(states, "source", "left").select(F.lit(run_id).alias("run_id"), "source", "success", error.alias("error"), F.col("records").alias("records_fetched"), F.coalesce("records_normalised", F.lit(0)).alias("records_normalised"), "states")


def append_run(documents: DataFrame, path: str) -> None:
    """Add the documents of a run to the log: runs are only ever appended."""
    documents.write.mode("append").parquet(path)


def pipeline_row(documents: DataFrame) -> DataFrame:
    """The sum of all sources of a run."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("source"))))
    return documents.agg(F.lit("_pipeline").alias("source"), F.bool_and("success").alias("success"), F.sum("records_fetched").alias("records_fetched"), F.sum("records_normalised").alias("records_normalised"), failed.alias("sources_failed"))


def unmapped(rows: DataFrame) -> DataFrame:
    own = _named(rows).where("_commodity is not null and commodity_alias_lookup_id is null")
    return own.groupBy("commodity_name").agg(F.count("*").alias("records"), F.array_sort(F.collect_set("_state")).alias("states"), F.array_sort(F.collect_set(F.coalesce("_system", "_source"))).alias("sources"), first_samples("_market").alias("sample_markets"))


def unknown_markets(rows: DataFrame) -> DataFrame:
    own = _named(rows).where("_market is not null and market_id is null")
    return own.groupBy(F.col("_state").alias("state"), "market_name").agg(F.count("*").alias("records"), F.array_sort(F.collect_set(F.coalesce("_system", "_source"))).alias("sources"), first_samples("_commodity").alias("sample_commodities"))


def has_price_problem(lo: Column, hi: Column, modal: Column) -> Column:
    """Whether price_problems() has any, without its texts."""
    outside = (lo <= hi) & ((modal < lo) | (modal > hi))
    return F.greatest(*(F.coalesce(c, F.lit(False)) for c in (lo <= 0, hi <= 0, modal <= 0, lo > hi, outside)))


def bad_prices(rows: DataFrame, limit: int = MAX_PRICE_ITEMS) -> DataFrame:
    """The first rows (by ordinal) with price problems; the limit is the queue's. Texts are made for those alone."""
    prices = [F.col(c) for c in ("min_price", "max_price", "modal_price")]
    return rows.where(has_price_problem(*prices)).orderBy("ordinal").limit(limit).withColumn("problems", price_problems(*prices))


def review_items(rows: DataFrame, status: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Items of four types for the review queue, keyed by text; a merge by REVIEW policies keeps their history."""
    day = X.date_key(now)
    none = F.lit(None).cast("string")
    no_list = F.array().cast("array<string>")

    def item(key: Column, kind: str, title: Column, details: Column, state: Column = none, source: Column = none, records: Column = F.lit(0), **lists: Column) -> list[Column]:
        sets = [lists.get(c, no_list).alias(c) for c in ("states", "sources", "sample_markets", "sample_commodities")]
        return [key.alias("key"), F.lit(kind).alias("type"), F.lit("open").alias("status"), title.alias("title"), details.alias("details"), state.alias("state"), source.alias("source"), now.alias("first_seen"), now.alias("last_seen"), F.lit(run_id).alias("last_run_id"), F.lit(1).cast("bigint").alias("times_seen"), records.cast("bigint").alias("records_seen"), *sets]

    c = F.col
    text = lambda x: F.coalesce(x.cast("string"), F.lit("None"))
    error = F.substring(F.coalesce(c("details"), c("error"), F.lit("invalid payload")), 1, 1000)
    failed = status.where("not success").select(*item(F.concat_ws("|", F.lit("run_failed"), c("source"), day), "run_failed", F.concat(c("source"), F.lit(" scrape failed on "), day), F.to_json(F.struct(error.alias("error"), day.alias("date"))), source=c("source")))
    crops = unmapped(rows).select(*item(F.concat(F.lit("unmapped_commodity|"), c("commodity_name")), "unmapped_commodity", F.concat(F.lit("Crop name not matched: "), c("commodity_name")), F.to_json(F.struct("commodity_name")), records=c("records"), states=c("states"), sources=c("sources"), sample_markets=c("sample_markets")))
    markets = unknown_markets(rows).select(*item(F.concat_ws("|", F.lit("unknown_market"), c("state"), c("market_name")), "unknown_market", F.concat(F.lit("Market not found: "), c("market_name"), F.lit(" ("), c("state"), F.lit(")")), F.to_json(F.struct("market_name")), state=c("state"), records=c("records"), sources=c("sources"), sample_commodities=c("sample_commodities")))
    date = X.date_key(c("date"))
    prices = bad_prices(rows).select(*item(F.concat_ws("|", F.lit("price_invalid"), *(text(x) for x in (c("source_system"), c("state"), c("market_name"), c("commodity_name"), c("variety"), date))), "price_invalid", F.concat(F.lit("Price looks wrong: "), text(c("commodity_name")), F.lit(" at "), text(c("market_name")), F.lit(" on "), text(date)), F.to_json(F.struct("problems", "market_name", "commodity_name", "variety", date.alias("date"), "min_price", "max_price", "modal_price")), state=c("state"), source=c("source_system"), records=F.lit(1)))
    return failed.unionByName(crops).unionByName(markets).unionByName(prices).withColumn("ordinal", F.lit(0))


def suggestions(best: DataFrame, now: Column, script: str) -> DataFrame:
    """Guesses of the fuzzy matcher (name, records, best_id, best_name, score, reason) as review rows for a person to approve: a merge by SUGGESTION policies keeps what the queue knows."""
    c = F.col
    guess = F.struct(c("best_id").cast("string").alias("group_id"), c("best_name").alias("group_name"), F.round(F.coalesce("score", F.lit(0.0)), 3).alias("score"), c("reason").alias("reason"), F.lit(script).alias("by"), now.alias("at"))
    return best.select(F.concat(F.lit("unmapped_commodity|"), "name").alias("key"), F.lit("unmapped_commodity").alias("type"), F.lit("open").alias("status"), F.concat(F.lit("Crop name not matched: "), "name").alias("title"), F.to_json(F.struct(c("name").alias("commodity_name"))).alias("details"), now.alias("first_seen"), now.alias("last_seen"), F.coalesce(c("records"), F.lit(0)).cast("bigint").alias("records_seen"), guess.alias("suggestion"), F.lit(0).alias("ordinal"))


def overall_status(status: DataFrame) -> DataFrame:
    """SUCCESS, PARTIAL or FAILED over all sources, with their numbers."""
    ok, bad = F.count_if("success"), F.count_if(~F.col("success"))
    return status.agg(ok.alias("ok"), bad.alias("failed"), F.sum("records").alias("records")).withColumn("status", F.when(F.col("failed") == 0, "SUCCESS").when(F.col("ok") > 0, "PARTIAL").otherwise("FAILED"))


def source_lines(status: DataFrame, national: str = NATIONAL) -> DataFrame:
    """Sources for the report, the national feed first and then by name, with what to show."""
    shown = F.when(F.col("success") & (F.col("records") == 0), "SKIPPED").when(F.col("success"), "OK").otherwise(F.concat(F.lit("FAILED: "), X.error_text(F.col("error"), F.col("details"), 220)))
    order = Window.orderBy(F.when(F.col("source") == national, 0).otherwise(1), F.lower("source"))  # one row for each source
    return status.withColumn("shown", shown).withColumn("place", F.row_number().over(order))


def impact_export(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Names without an alias entry and what hangs on them, for a CSV to be filled in, largest first."""
    own = dim.where("commodity_alias_lookup_id is null and commodity_name is not null")
    counts = facts.groupBy("market_commodity_id").agg(F.count("*").alias("_facts"))
    names = lambda c: F.array_join(F.array_sort(F.filter(F.collect_set(c), lambda x: x != "")), " | ")
    out = own.join(counts, "market_commodity_id", "left").groupBy("commodity_name").agg(F.coalesce(F.sum("_facts"), F.lit(0)).alias("price_record_count"), F.count("*").alias("master_doc_count"), names("state").alias("states"), names("source_system").alias("source_systems"), names("variety").alias("varieties"), names("commodity_group").alias("commodity_group"))
    empty = [F.lit("").alias(c) for c in ("canonical_name", "crop_master_id", "additional_aliases", "notes")]
    return out.select("*", *empty).orderBy(F.desc("price_record_count"), "commodity_name")


def alias_documents(rows: DataFrame) -> DataFrame:
    """Alias entries from a sheet (ordinal, crop_master_id, crop_name, market_name, aliases, note): one for each crop id, else name."""
    key = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("crop_master_id", "crop_name", "market_name")))
    every = F.transform(F.concat(F.array("crop_name", "market_name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda a: F.lower(F.trim(a)))
    clean = rows.withColumn("_key", F.lower(key)).withColumn("_aliases", F.filter(every, lambda a: a.isNotNull() & (a != ""))).where("_key is not null")
    grouped = clean.groupBy("_key").agg(
        F.min_by(F.coalesce("crop_name", "market_name"), "ordinal").alias("canonical_name"),
        F.max_by("crop_master_id", F.when(F.col("crop_master_id").isNotNull(), F.col("ordinal"))).alias("crop_master_id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_aliases")))).alias("aliases"),
        F.when(F.bool_or(F.col("crop_master_id").isNull()), F.lit(0.0)).otherwise(F.lit(1.0)).alias("confidence"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("note").isNotNull(), F.struct("ordinal", "note")))), lambda s: s["note"]), "; ").alias("notes"),
    )
    return grouped.withColumn("language_variants", F.filter("aliases", X.has_non_ascii)).drop("_key")
