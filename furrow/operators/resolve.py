"""Entity resolution: tiers of equi-joins on derived keys, and fuzzy best matches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.data import load
from furrow.functions import scalars as X
from furrow.functions.fuzzy import MIN_MARGIN, MIN_SCORE, SURE, Lookup, candidate_names
from furrow.session import ship

#: Words that say nothing about a crop.
STOP_WORDS: list[str] = load("words")["stop_words"]
#: Entries of a lookup that are sent to tasks at once.
LOOKUP_ENTRIES = 20_000


def _by_sort(df: DataFrame) -> DataFrame:
    """df as a side that is sorted, never broadcast: keys grow with the entities, and the planner takes them to be as small as their compressed files."""
    return df.hint("merge")


def _entity_keys(entities: DataFrame) -> DataFrame:
    """Rows (entity_id, e_state, e_key, is_alias): names and aliases in lower case."""
    names = F.array(F.struct(F.lower("name").alias("k"), F.lit(0).alias("a")))
    aliases = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(F.lower(a).alias("k"), F.lit(1).alias("a")))
    each = entities.select(F.col("id").alias("entity_id"), F.lower("state").alias("e_state"), F.explode(F.concat(names, aliases)).alias("x"))
    return each.select("entity_id", "e_state", F.col("x.k").alias("e_key"), F.col("x.a").alias("is_alias")).where("e_key is not null").distinct()


def resolve_markets(names: DataFrame, entities: DataFrame) -> DataFrame:
    """Rows (market_name, state, market_id, tier) for the distinct names of names (market_name, state).

    Tiers: 1 name, 2 alias, 3 to 5 with and without market words, 6 any state. The
    lowest tier wins, then the smallest id. Patterns are variants of the probe's
    key, so every tier is one equi-join; white space before a final apmc is
    collapsed on both sides for the tiers that allow it.
    """
    probes = names.select("market_name", "state").distinct()
    key = F.lower(X.strip(F.col("market_name")))
    bare = X.without_suffix(key)
    changed = (bare != "") & (bare != key)

    def tier(no: int, k: Column, any_state: bool, alias: int, loose: bool) -> Column:
        return F.struct(F.lit(no).alias("tier"), k.alias("k"), F.lit(any_state).alias("any_state"), F.lit(alias).alias("alias"), F.lit(loose).alias("loose"))

    tiers = [
        tier(1, key, False, 0, False),
        tier(2, key, False, 1, False),
        tier(3, F.when(~key.endswith(" apmc"), F.concat(key, F.lit(" apmc"))), False, -1, True),
        tier(4, F.when(changed, bare), False, -1, False),
        tier(5, F.when(changed, F.concat(bare, F.lit(" apmc"))), False, -1, True),
        tier(6, key, True, -1, False),
    ]
    tried = probes.withColumn("p_state", X.canonical_state(F.col("state"))).withColumn("t", F.explode(F.array(*tiers)))
    tried = tried.select("market_name", "state", "p_state", "t.*").where("k is not null and k <> ''")
    plain = _entity_keys(entities).withColumn("e_loose", F.lit(False))
    ended = plain.where(F.col("e_key").rlike(r"\sapmc$"))
    loose = ended.withColumn("e_key", F.concat(F.regexp_replace("e_key", r"\s+apmc$", ""), F.lit(" apmc"))).withColumn("e_loose", F.lit(True))
    found = tried.join(_by_sort(plain.union(loose)), (F.col("k") == F.col("e_key")) & (F.col("loose") == F.col("e_loose")))
    same = F.col("any_state") | F.col("p_state").isNull() | (F.col("p_state") == "") | (F.col("p_state") == F.col("e_state"))
    right = (F.col("alias") == -1) | (F.col("alias") == F.col("is_alias"))
    best = found.where(same & right).groupBy("market_name", "state").agg(F.min(F.struct("tier", "entity_id")).alias("b"))
    on = [F.col("p.market_name").eqNullSafe(F.col("b.market_name")), F.col("p.state").eqNullSafe(F.col("b.state"))]
    return probes.alias("p").join(_by_sort(best.alias("b")), on, "left").select("p.market_name", "p.state", F.col("b.b.entity_id").alias("market_id"), F.col("b.b.tier").alias("tier"))


def resolve_offline(names: DataFrame, entities: DataFrame) -> DataFrame:
    """As resolve_markets, by the rules of the batch repair: states canonical on both sides, more market words.

    Exact keys go to the last entity (greatest id), keys without market words to the
    first; order: exact, bare, key apmc, bare apmc, any state.
    """
    e = entities.select(F.col("id").alias("entity_id"), X.canonical_state(X.collapse(F.col("state"))).alias("e_state"), F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n"))
    e = e.withColumn("exact", X.collapse(F.col("n"))).where("exact <> ''")
    exact = e.groupBy("e_state", F.col("exact").alias("k")).agg(F.max("entity_id").alias("entity_id"))
    bare = e.withColumn("k", X.without_suffix(F.col("exact"), X.MARKET_SUFFIXES_OFFLINE)).where("k <> ''").groupBy("e_state", "k").agg(F.min("entity_id").alias("entity_id"))
    keys = exact.unionByName(bare.join(_by_sort(exact.select("e_state", "k")), ["e_state", "k"], "left_anti"))
    keys = keys.withColumn("e_state", F.coalesce("e_state", F.lit("")))
    probes = names.select("market_name", "state").where(F.trim("market_name") != "").distinct()
    key = X.collapse(F.col("market_name"))
    short = X.without_suffix(key, X.MARKET_SUFFIXES_OFFLINE)
    forms = F.array(
        F.struct(F.lit(1).alias("tier"), key.alias("k")),
        F.struct(F.lit(2).alias("tier"), F.nullif(short, F.lit("")).alias("k")),
        F.struct(F.lit(3).alias("tier"), F.when(short != "", F.concat(key, F.lit(" apmc"))).alias("k")),
        F.struct(F.lit(4).alias("tier"), F.when(short != "", F.concat(short, F.lit(" apmc"))).alias("k")),
    )
    tried = probes.withColumn("e_state", F.coalesce(X.canonical_state(X.collapse(F.col("state"))), F.lit(""))).withColumn("f", F.explode(forms))
    near = tried.select("market_name", "state", "e_state", "f.tier", "f.k").join(_by_sort(keys), ["e_state", "k"]).select("market_name", "state", "tier", "entity_id")
    far = probes.withColumn("k", key).join(_by_sort(keys.groupBy("k").agg(F.min("entity_id").alias("entity_id"))), "k").select("market_name", "state", F.lit(5).alias("tier"), "entity_id")
    best = near.union(far).groupBy("market_name", "state").agg(F.min(F.struct("tier", "entity_id")).alias("b"))
    on = [F.col("p.market_name").eqNullSafe(F.col("b.market_name")), F.col("p.state").eqNullSafe(F.col("b.state"))]
    return probes.alias("p").join(_by_sort(best.alias("b")), on, "left").select("p.market_name", "p.state", F.col("b.b.entity_id").alias("market_id"), F.col("b.b.tier").alias("tier"))


def new_markets(resolved: DataFrame) -> DataFrame:
    """New market rows for names that nothing resolves."""
    left = resolved.where("market_id is null and trim(market_name) <> ''").select(X.canonical_state(F.col("state")).alias("state"), X.title_case(F.col("market_name")).alias("name")).distinct()
    return left.withColumn("id", X.surrogate_key(F.col("state"), F.col("name"))).withColumn("aliases", F.array().cast("array<string>")).withColumn("source", F.lit("auto_resolved"))


def resolve_aliases(names: DataFrame, lookup: DataFrame, name: str = "alias_input") -> DataFrame:
    """Names with the id of the alias entry that holds them exactly; the smallest id if several do."""
    keys = lookup.select(F.col("id").alias("commodity_alias_lookup_id"), F.explode("aliases").alias("_k")).groupBy("_k").agg(F.min("commodity_alias_lookup_id").alias("commodity_alias_lookup_id"))
    return names.withColumn("_k", X.lower_strip(F.col(name))).join(keys, "_k", "left").drop("_k")


def _grams(text: Column, size: int = 3) -> Column:
    """The distinct stretches of 1 to size characters of a text."""

    def of(k: int) -> Column:
        starts = F.when(F.length(text) >= k, F.sequence(F.lit(1), F.length(text) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substr(text, i, F.lit(k)))

    return F.array_distinct(F.concat(*(of(k) for k in range(1, size + 1))))


def _containing(needles: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows of needles (.., needle) joined with aliases (.., alias) that contain them: an equi-join on the needle's first three characters, then the test."""
    n = needles.where(F.length("needle") > 0).withColumn("_gram", F.substring("needle", 1, 3))
    return n.join(aliases.withColumn("_gram", F.explode(_grams(F.col("alias")))), "_gram").where(F.col("alias").contains(F.col("needle"))).drop("_gram")


def crop_master_id(names: DataFrame, lookup: DataFrame, name: str = "name") -> DataFrame:
    """Names with a crop id: exact alias first, then an alias that contains the name; the smallest entry wins."""
    usable = lookup.where(F.coalesce("crop_master_id", F.lit("")) != "").select("id", "crop_master_id", F.explode("aliases").alias("alias"))
    low = names.select(name).distinct().withColumn("needle", X.lower_strip(F.col(name)))
    hit = _containing(low, usable).withColumn("rank", F.when(F.col("alias") == F.col("needle"), 1).otherwise(2))
    best = hit.groupBy(name).agg(F.min(F.struct("rank", "id", "crop_master_id")).alias("b"))
    return low.drop("needle").join(best, name, "left").select(name, F.col("b.crop_master_id").alias("crop_master_id"), F.col("b.rank").alias("rank"))


def token_match(names: DataFrame, crops: DataFrame, name: str = "name") -> DataFrame:
    """The first crop (by ordinal) with an alias that a candidate of the name equals, or that contains the clean name or one of its words."""
    clean = F.trim(F.regexp_replace(F.trim(name), r"[()/\-]", " "))
    words = F.filter(F.split(clean, r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(*STOP_WORDS))
    probes = names.select(name).distinct()
    each = crops.select("ordinal", "crop_id", F.explode("aliases").alias("alias"))
    same = probes.withColumn("alias", F.explode(candidate_names(F.col(name)))).join(each, "alias")
    inside = _containing(probes.withColumn("needle", F.explode(F.array_distinct(F.concat(F.array(clean), words)))), each)
    best = same.select(name, "ordinal", "crop_id").union(inside.select(name, "ordinal", "crop_id")).groupBy(name).agg(F.min(F.struct("ordinal", "crop_id")).alias("b"))
    return probes.join(best, name, "left").select(name, F.col("b.crop_id").alias("crop_id"))


def fuzzy_best(names: DataFrame, lookup: DataFrame, name: str = "name", contained: int = 5, block: int = LOOKUP_ENTRIES) -> DataFrame:
    """Best and second score of each distinct name over the lookup's names, and whether it is accepted.

    Names are distinct before they meet the lookup, in Arrow batches. The lookup (a hand-kept table of some
    thousand names) is sent out in blocks of block entries, so its size is bounded, and each block gives its best two.
    """
    spark = names.sparkSession
    ship(spark)
    probes = names.select(F.col(name).alias("name")).where(F.trim(name) != "").distinct()
    entries = lookup.select(F.col("id").cast("string").alias("id"), "canonical_name", F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"))
    blocks = max(1, -(-entries.count() // block))
    pairs = None
    for k in range(blocks):  # one, unless the lookup is large
        own = entries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).select("id", "names").collect()
        held = spark.sparkContext.broadcast([(r.id, r.names) for r in own])

        def run(frames: Iterable[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            known = Lookup(held.value, contained)
            for f in frames:
                yield pd.DataFrame([(n, i, s) for n in f["name"] for s, i in known.best_two(n)], columns=["name", "id", "score"])

        found = probes.mapInPandas(run, "name string, id string, score double")
        pairs = found if pairs is None else pairs.union(found)
    order = Window.partitionBy("name").orderBy(F.desc("score"), "id")
    top = pairs.withColumn("r", F.row_number().over(order)).where("r <= 2").groupBy("name").agg(
        F.max(F.when(F.col("r") == 1, F.col("id"))).alias("best_id"),
        F.max(F.when(F.col("r") == 1, F.col("score"))).alias("score"),
        F.coalesce(F.max(F.when(F.col("r") == 2, F.col("score"))), F.lit(0.0)).alias("second"),
    )
    sure = (F.col("score") >= MIN_SCORE) & ((F.col("score") - F.col("second") >= MIN_MARGIN) | (F.col("score") >= SURE))
    why = F.when(sure, F.lit(None).cast("string")).when(F.col("score") < MIN_SCORE, "score too low").otherwise("margin too small")
    top = top.join(entries.select(F.col("id").alias("best_id"), F.col("canonical_name").alias("best_name")), "best_id", "left")
    return top.select(F.col("name").alias(name), "best_id", "best_name", "score", "second", sure.alias("accepted"), why.alias("reason"))
