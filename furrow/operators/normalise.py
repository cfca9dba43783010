"""Raw records of all sources in one schema, with bad rows set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.functions import scalars as X
from furrow.operators.merge import DIM_KEY
from furrow.sources.landed import with_provenance
from furrow.sources.specs import COMPAT, SPECS



def _field(record: Column, names: list[str]) -> Column:
    values = [record[n] for n in names]
    return X.first_truthy(*values) if values else F.lit(None).cast("string")


def normalise(records: DataFrame, compat: bool = False) -> DataFrame:
    """Rows in the one schema from records (source, ordinal, record map<string,string>).

    All sources share a single pass: for each target a case over the source
    picks its fields. Sources without a spec are left out. _error says what can't
    be read: such rows go to quarantine().
    """
    known = records.where(F.col("source").isin(*SPECS))

    def pick(target: str) -> Column:
        out = None
        for source, spec in SPECS.items():
            names = COMPAT.get(source, {}).get(target, spec.get(target)) if compat else spec.get(target)
            if names:
                c = F.col("source") == source
                v = _field(F.col("record"), names)
                out = F.when(c, v) if out is None else out.when(c, v)
        return out if out is not None else F.lit(None).cast("string")

    targets = ["date", "market", "commodity", "variety", "group", "grade", "arrival", "min", "max", "modal", "state"]
    other = pick("alias_input") if compat else F.lit(None).cast("string")
    alias = F.when(F.col("source").isin(*(k for k, v in COMPAT.items() if "alias_input" in v)), other).otherwise(pick("commodity")) if compat else pick("commodity")
    # a generator between picking and parsing: each pick is computed once, however often later expressions use it
    picked = known.select("source", "ordinal", F.inline(F.array(F.struct(*(pick(t).alias(f"raw_{t}") for t in targets), alias.alias("raw_alias")))))
    system = F.create_map(*(F.lit(v) for s, spec in SPECS.items() for v in (s, spec["system"])))
    raw = {t: F.col(f"raw_{t}") for t in (*targets, "alias")}
    text = {"market_name": "market", "commodity_name": "commodity", "variety": "variety", "commodity_group": "group", "grade": "grade", "alias_input": "alias"}
    numbers = {"arrival_quantity": "arrival", "min_price": "min", "max_price": "max", "modal_price": "modal"}
    out = picked.select(
        "source",
        "ordinal",
        "raw_date",
        system[F.col("source")].alias("source_system"),
        X.lower_strip(X.first_truthy(raw["state"], F.regexp_replace("source", "_", " "))).alias("state"),
        *(X.lower_strip(raw[t]).alias(n) for n, t in text.items()),
        X.parse_date(raw["date"]).alias("date"),
        *(X.to_price(raw[t], strict=not compat).alias(n) for n, t in numbers.items()),
    )
    unread = F.when(F.col("raw_date").isNotNull() & (F.col("raw_date") != "") & F.col("date").isNull(), F.concat(F.lit("date: "), F.col("raw_date")))
    return with_provenance(out.withColumn("_error", unread)).drop("raw_date")


def unknown_sources(records: DataFrame) -> DataFrame:
    return records.where(~F.col("source").isin(*SPECS)).groupBy("source").count()


def guard(rows: DataFrame, now: Column) -> DataFrame:
    """Rows that aren't from a future day and have some part of the key; undated rows pass."""
    some = F.coalesce(*(F.col(c) for c in DIM_KEY)).isNotNull()
    return rows.where(~X.is_future(F.col("date"), now) & some)


def quarantine(rows: DataFrame, now: Column) -> DataFrame:
    """Rows that guard() or a parser rejects, with the reason."""
    reason = F.when(X.is_future(F.col("date"), now), F.lit("future date")).otherwise(F.col("_error"))
    return rows.withColumn("reason", reason).where("reason is not null")


def quarantine_summary(bad: DataFrame, samples: int = 5) -> DataFrame:
    """Rejected rows by source, with the first few reasons by ordinal."""
    few = F.slice(F.array_sort(F.collect_set(F.when(F.col("nth") <= samples, F.struct("ordinal", "reason")))), 1, samples)
    nth = F.row_number().over(Window.partitionBy("source").orderBy("ordinal"))
    return bad.withColumn("nth", nth).groupBy("source").agg(F.count("*").alias("rejected"), F.array_join(F.transform(few, lambda s: s["reason"]), "; ").alias("samples"))
