"""Audits: many counts over one table fused into one pass, and diagnostics of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fused_counts(df: DataFrame, section: str, metrics: dict[str, Column]) -> DataFrame:
    """Rows (section, metric, value, total): one aggregation, whatever the number of metrics, turned to long form."""
    one = df.agg(F.count("*").alias("_total"), *(F.count_if(c).alias(f"m{i}") for i, c in enumerate(metrics.values())))
    parts = ", ".join(f"'{name}', m{i}" for i, name in enumerate(metrics))
    return one.select(F.lit(section).alias("section"), F.expr(f"stack({len(metrics)}, {parts}) as (metric, value)"), F.col("_total").alias("total"))


def nulls(df: DataFrame, section: str, columns: list[str]) -> DataFrame:
    """Null counts with their share and severity: warn under a tenth, else err."""
    found = fused_counts(df, section, {c: F.col(c).isNull() for c in columns})
    share = F.when(F.col("total") > 0, F.round(F.lit(100.0) * F.col("value") / F.col("total"), 2)).otherwise(F.lit(0.0))
    severity = F.when(F.col("value") == 0, "ok").when(F.lit(10) * F.col("value") < F.col("total"), "warn").otherwise("err")
    return found.withColumn("pct", share).withColumn("severity", severity)


def price_logic(lo: str, hi: str, modal: str) -> dict[str, Column]:
    """Counts of prices that contradict each other; a null takes no part."""
    a, b, m = F.col(lo), F.col(hi), F.col(modal)
    any_of = lambda f: F.coalesce(f(a), F.lit(False)) | F.coalesce(f(b), F.lit(False)) | F.coalesce(f(m), F.lit(False))
    return {"min_above_max": a > b, "modal_above_max": m > b, "modal_below_min": m < a, "negative": any_of(lambda x: x < 0), "zero": any_of(lambda x: x == 0)}


def duplicate_groups(df: DataFrame, key: list[str], ident: str | None = None) -> DataFrame:
    """Groups of more than one row with their number, extra rows and (with ident) the first and last of their ids."""
    agg = [F.count("*").alias("n")]
    if ident:
        agg += [F.min(ident).alias("first_id"), F.max(ident).alias("last_id")]
    return df.groupBy(*key).agg(*agg).where("n > 1").withColumn("extra", F.col("n") - 1)


def duplicate_rows(df: DataFrame, key: list[str], ident: str) -> DataFrame:
    """The ids of all rows of such groups, a row each, so that a group may have any size."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in key]
    return df.alias("d").join(groups.alias("g"), on).select(*(F.col(f"d.{k}") for k in key), F.col(f"d.{ident}"), "g.n")


def unmatched_names(df: DataFrame, name: str, fk: str) -> DataFrame:
    """Lower-case names (null as empty) without a foreign key, with the number of their rows."""
    return df.where(F.col(fk).isNull()).groupBy(F.lower(F.coalesce(F.col(name), F.lit(""))).alias("name")).agg(F.count("*").alias("n"))


def null_safe_distinct(*xs: Column) -> Column:
    """A distinct count to which null counts as a value."""
    return F.count_distinct(F.to_json(F.struct(*(x.alias(f"c{i}") for i, x in enumerate(xs)))))


def distinct_values(c: str) -> Column:
    """The distinct values of a column in order, null among them as an empty text."""
    return F.array_sort(F.collect_set(F.coalesce(F.col(c).cast("string"), F.lit(""))))


def source_overlap(df: DataFrame, key: list[Column], source: str) -> DataFrame:
    """Keys that more than one source (null is one) has, counted by the set of sources."""
    sets = df.groupBy(*key).agg(distinct_values(source).alias("sources"), F.count("*").alias("n")).where(F.size("sources") > 1)
    return sets.groupBy(F.array_join("sources", "|").alias("sources")).agg(F.count("*").alias("keys"), F.sum("n").alias("docs"))


def variants(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """Groups that carry more than one name; null is one."""
    found = df.groupBy(*key).agg(F.count("*").alias("n"), distinct_values(name).alias("_names")).where("n > 1 and size(_names) > 1")
    return found.select(*key, "n", F.size("_names").cast("bigint").alias("n_names"), F.array_join("_names", "|").alias("names"))


def quality_holes(df: DataFrame, by: str, columns: list[str], texts: tuple[str, ...] = ()) -> DataFrame:
    """Rows (by, metric, value, total): nulls of columns and empty texts, for each value of by, in one pass."""
    metrics = {f"{c}_null": F.col(c).isNull() for c in columns} | {f"{c}_empty": F.trim(c) == "" for c in texts}
    one = df.groupBy(by).agg(F.count("*").alias("total"), *(F.count_if(x).alias(f"m{i}") for i, x in enumerate(metrics.values())))
    parts = ", ".join(f"'{name}', m{i}" for i, name in enumerate(metrics))
    return one.select(by, F.expr(f"stack({len(metrics)}, {parts}) as (metric, value)"), "total")


def grand_total(found: DataFrame) -> DataFrame:
    """Rows of nulls() with one more for all columns of all sections together."""
    every = found.agg(F.sum("value").alias("value"), F.sum("total").alias("total"))
    share = F.when(F.col("total") > 0, F.round(F.lit(100.0) * F.col("value") / F.col("total"), 2)).otherwise(F.lit(0.0))
    severity = F.when(F.col("value") == 0, "ok").when(F.lit(10) * F.col("value") < F.col("total"), "warn").otherwise("err")
    return found.unionByName(every.select(F.lit("all").alias("section"), F.lit("all").alias("metric"), "value", "total", share.alias("pct"), severity.alias("severity")))


def distribution(df: DataFrame, column: str, small: int = 5) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).withColumn("flag", F.when(F.col("n") < small, "WARN").otherwise("ok"))


def freshness(df: DataFrame, column: str, now: Column, days: int = 3) -> DataFrame:
    """Rows of the last days, the first and the latest time and the days since: one pass."""
    return df.agg(F.count_if(F.col(column) > now - F.make_dt_interval(F.lit(days))).alias("recent"), F.min(column).alias("first"), F.max(column).alias("latest"), F.datediff(now, F.max(column)).alias("days_since"))


def outliers(df: DataFrame, section: str, column: str, most: float = 1_000_000) -> DataFrame:
    return fused_counts(df, section, {"below_zero": F.col(column) < 0, "above_most": F.col(column) > most})


def array_health(df: DataFrame, section: str, array: str, ident: str) -> DataFrame:
    return fused_counts(df, section, {"no_aliases": F.size(F.coalesce(array, F.array().cast("array<string>"))) == 0, "no_crop_id": F.coalesce(ident, F.lit("")) == ""})


def geo_health(df: DataFrame, section: str) -> DataFrame:
    return fused_counts(df, section, {"no_location": F.col("location").isNull(), "no_state": F.col("state").isNull()})


def collection_stats(df: DataFrame, section: str) -> DataFrame:
    return fused_counts(df, section, {"unmapped": F.col("crop_master_id").isNull(), "unsure": (F.col("confidence") < 0.8) & F.coalesce("active", F.lit(True))})


def orphans(child: DataFrame, parent: DataFrame, fk: str, ident: str) -> DataFrame:
    """Rows (fk, n) of foreign keys without a parent."""
    return child.groupBy(fk).agg(F.count("*").alias("n")).join(parent.select(F.col(ident).alias(fk)), fk, "left_anti")


def childless(parent: DataFrame, child: DataFrame, ident: str, fk: str) -> DataFrame:
    return parent.join(child.select(F.col(fk).alias(ident)), ident, "left_anti")


#: The rules of the nightly audit: section, metric, level and message of what should be zero.
RULES = [
    ("prices", "min_above_max", "critical", "minimum above maximum"),
    ("prices", "negative", "critical", "negative prices"),
    ("facts", "future", "critical", "dates in the future"),
    ("facts", "orphans", "critical", "prices without their entry"),
    ("facts", "duplicates", "critical", "two prices of one entry and day"),
    ("prices", "modal_above_max", "warning", "modal price above maximum"),
    ("prices", "modal_below_min", "warning", "modal price below minimum"),
    ("prices", "zero", "warning", "prices of zero"),
    ("dims", "childless", "warning", "entries without prices"),
    ("dims", "market_id", "warning", "entries without a market"),
    ("dims", "commodity_alias_lookup_id", "warning", "entries without a crop"),
    ("arrivals", "below_zero", "warning", "negative arrivals"),
    ("arrivals", "above_most", "warning", "arrivals beyond belief"),
]


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "section string, metric string, level string, message string")


def rollup(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (section, metric, level, message) that some row breaks."""
    return metrics.join(F.broadcast(rules), ["section", "metric"]).where("value > 0").select("level", "section", "metric", "value", "message")


def uniqueness(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """For each named key whether it is unique: rows, distinct keys, and the verdict. The table is read once."""
    each = [F.struct(F.lit(name).alias("constraint"), F.to_json(F.struct(*(F.col(c) for c in cols))).alias("key")) for name, cols in keys.items()]
    groups = df.select(F.inline(F.array(*each))).groupBy("constraint", "key").agg(F.count("*").alias("n"))
    found = groups.groupBy("constraint").agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), (F.max("n") <= 1).alias("holds"))
    names = df.sparkSession.createDataFrame([(n,) for n in keys], "constraint string")
    return F.broadcast(names).join(found, "constraint", "left").select("constraint", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("holds", F.lit(True)).alias("holds"))
