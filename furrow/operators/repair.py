"""Repairs as plans: each returns rows with an action, and apply_plan() carries them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.functions import scalars as X
from furrow.operators.merge import IMPORT, merge


def backfill(rows: DataFrame, found: DataFrame, on: list[str], column: str) -> DataFrame:
    """Rows whose column is null with the value of found; others keep theirs."""
    b = found.select(*on, F.col(column).alias("_found")).dropDuplicates(on)
    joined = rows.join(b, on, "left")
    return joined.withColumn("action", F.when(F.col(column).isNull() & F.col("_found").isNotNull(), "fill").otherwise("keep")).withColumn(column, F.coalesce(column, "_found")).drop("_found")


def overlap_pairs(dim: DataFrame, key: list[str], label: str, keep: str, old: str, ident: str = "id") -> DataFrame:
    """Rows (keep_id, old_id): entries of two labels with the same key; the smallest id stands for each."""
    side = lambda x: F.min(F.when(F.col(label) == x, F.col(ident)))
    return dim.where(F.col(label).isin(keep, old)).groupBy(*key).agg(side(keep).alias("keep_id"), side(old).alias("old_id")).where("keep_id is not null and old_id is not null").select("keep_id", "old_id")


def merge_sources(facts: DataFrame, pairs: DataFrame, fk: str, date: str, ident: str) -> DataFrame:
    """Facts of merged entries as a plan: remap or drop those of the old, keep all others.

    On a date that the kept entry has, its own fact stays; among old ones the first does.
    """
    p = pairs.select(F.col("old_id").alias(fk), "keep_id")
    moved = facts.join(p, fk, "left").withColumn("target", F.coalesce("keep_id", fk)).withColumn("is_old", F.col("keep_id").isNotNull())
    order = Window.partitionBy("target", date).orderBy("is_old", ident)
    ranked = moved.withColumn("nth", F.row_number().over(order))
    action = F.when(~F.col("is_old"), "keep").when(F.col("nth") == 1, "remap").otherwise("drop")
    return ranked.withColumn("action", action).drop("nth", "is_old", "keep_id")


def merge_dims(dim: DataFrame, pairs: DataFrame, fks: list[str], ident: str = "id") -> DataFrame:
    """Dimension rows after a merge: the old are dropped, and give the kept what it lacks."""
    gone = pairs.select(F.col("old_id").alias(ident))
    if not fks:
        return dim.join(gone, ident, "left_anti").select(dim.columns)
    old = dim.select(F.col(ident).alias("old_id"), *(F.col(c).alias(f"_{c}") for c in fks)).join(pairs, "old_id").groupBy("keep_id").agg(*(F.min(f"_{c}").alias(f"_{c}") for c in fks)).withColumnRenamed("keep_id", ident)
    kept = dim.join(gone, ident, "left_anti").join(old, ident, "left")
    return kept.select(*(F.coalesce(c, f"_{c}").alias(c) if c in fks else F.col(c) for c in dim.columns))


def rename_source(dim: DataFrame, facts: DataFrame, label: str, old: str, new: str, key: list[str], fk: str, date: str, fact_id: str, ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """(dimension, facts) after entries of one label have got another: those that then have an entry's key already are merged into it."""
    pairs = overlap_pairs(dim, key, label, new, old, ident)
    left = merge_dims(dim, pairs, [], ident).withColumn(label, F.when(F.col(label) == old, F.lit(new)).otherwise(F.col(label)))
    return left, merge_sources(facts, pairs, fk, date, fact_id)


def orphan_facts(facts: DataFrame, dim: DataFrame, fk: str, ident: str = "id") -> DataFrame:
    """Facts without their dimension row, to be deleted."""
    return facts.join(dim.select(F.col(ident).alias(fk)), fk, "left_anti").withColumn("action", F.lit("delete"))


def swap_plan(facts: DataFrame, fk: str, date: str, now: Column, only: Column | None = None) -> DataFrame:
    """Future facts (those that only is true of) with the date that an exchange of day and month gives: move, or delete where that is no help.

    Delete if the date can't be exchanged, stays in the future or the same, or is taken already.
    """
    future = facts.where((F.col(date) > now) & (F.lit(True) if only is None else only))
    moved = future.withColumn("new_date", X.swap_day_month(F.col(date)))
    taken = facts.select(F.col(fk).alias("_fk"), F.to_date(date).alias("_day"), F.lit(True).alias("_taken")).distinct()
    plan = moved.join(taken, (F.col(fk) == F.col("_fk")) & (F.col("new_date") == F.col("_day")), "left")
    useless = (F.dayofmonth(date) > 12) | (F.col("new_date") == F.to_date(date)) | (F.col("new_date") > F.to_date(now)) | F.coalesce("_taken", F.lit(False))
    return plan.withColumn("action", F.when(useless, "delete").otherwise("move")).drop("_fk", "_day", "_taken")


def delete_source(dim: DataFrame, facts: DataFrame, label: str, value: str, fk: str, date: str, first: str | None = None, last: str | None = None, ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """(dimension, facts) after the facts of a source (between two days, if given) and then its empty entries are gone."""
    own = dim.where(F.col(label) == value).select(F.col(ident).alias(fk))
    inside = F.lit(True)
    if first:
        inside &= F.to_date(date) >= F.to_date(F.lit(first))
    if last:
        inside &= F.to_date(date) <= F.to_date(F.lit(last))
    marked = facts.join(own.withColumn("_own", F.lit(True)), fk, "left")
    left = marked.where(~(F.coalesce("_own", F.lit(False)) & F.coalesce(inside, F.lit(False)))).drop("_own").select(facts.columns)
    empty = own.join(left.select(fk).distinct(), fk, "left_anti").withColumnRenamed(fk, ident)
    return dim.join(empty, ident, "left_anti").select(dim.columns), left


def import_aliases(lookup: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alias table, ids of names) after an import of rows (ordinal, name, canonical_name, additional_aliases, crop_master_id, duplicates, notes).

    lookup has id and the columns of IMPORT. Rows without duplicates go first: to the entry (the smallest id) that has their
    canonical name (else their name) as name or alias, or to a new one. Then the others add their names to the entry that
    they name: that of a row of the import, one of the table by name or alias, or a new one.
    """
    low = lambda c: F.nullif(X.lower_strip(F.col(c)), F.lit(""))
    own = rows.select("ordinal", low("name").alias("name"), F.coalesce(low("canonical_name"), low("name")).alias("canonical"), low("duplicates").alias("target"), X.alias_list(F.col("additional_aliases"), F.col("name"), F.coalesce("canonical_name", F.lit(""))).alias("aliases"), X.blank_to_null(F.col("crop_master_id")).alias("crop_master_id"), X.blank_to_null(F.col("notes")).alias("notes")).where("name is not null")

    def known(entries: DataFrame, column: str) -> DataFrame:
        names = F.explode(F.array_distinct(F.concat(F.array(F.lower("canonical_name")), F.coalesce("aliases", F.array().cast("array<string>")))))
        return entries.select("id", names.alias(column)).groupBy(column).agg(F.min("id").alias(f"_{column}"))

    def batch(found: DataFrame, canonical: str) -> DataFrame:
        return found.select("id", "ordinal", F.col(canonical).alias("canonical_name"), "crop_master_id", "aliases", F.array(F.lit("csv_import")).alias("source_tags"), F.when(F.col("crop_master_id").isNull(), 0.0).otherwise(1.0).alias("confidence"), F.lit(True).alias("active"), "notes")

    alone = own.where("target is null").join(known(lookup, "canonical"), "canonical", "left").join(known(lookup, "name"), "name", "left")
    alone = alone.withColumn("id", F.coalesce(F.least("_canonical", "_name"), X.surrogate_key(F.col("canonical"))))
    first = merge(lookup, batch(alone, "canonical"), ["id"], IMPORT).drop("action")
    by_row = alone.groupBy(F.col("name").alias("target")).agg(F.max_by("id", "ordinal").alias("_row"))
    others = own.where("target is not null").join(by_row, "target", "left").join(known(first, "target"), "target", "left")
    others = others.withColumn("id", F.coalesce("_row", "_target", X.surrogate_key(F.col("target")))).withColumn("aliases", F.when(F.coalesce("_row", "_target").isNull(), F.array_union("aliases", F.array("target"))).otherwise(F.col("aliases")))
    every = merge(first, batch(others, "target"), ["id"], IMPORT)
    ids = alone.select("name", "id", "ordinal").union(others.select("name", "id", "ordinal")).groupBy("name").agg(F.max_by("id", "ordinal").alias("commodity_alias_lookup_id"))
    return every, ids


def apply_plan(plan: DataFrame, gone: tuple[str, ...] = ("delete", "drop")) -> DataFrame:
    """Rows that a plan leaves, without its action."""
    return plan.where(~F.col("action").isin(*gone)).drop("action")
