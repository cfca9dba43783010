"""Structured Streaming: each micro-batch goes through the same merge as a daily run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from furrow.operators.merge import current_version, load_current, merge, save_version


def merge_stream(rows: DataFrame, table: str, key: list[str], policies: dict[str, str], checkpoint: str, order: str = "ordinal", trigger: dict | None = None) -> StreamingQuery:
    """Merge a stream into a versioned table. The batch number is the version, so a repeated batch can be told."""

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = load_current(spark, table)
        merged = merge(old, batch, key, policies, order).drop("action")
        save_version(merged.select(old.columns), table, number + 1)

    return rows.writeStream.foreachBatch(_once(one, table)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _once(f: Callable[[DataFrame, int], None], table: str) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, number: int) -> None:
        done, _ = current_version(batch.sparkSession, table)
        if done <= number:
            f(batch, number)

    return run


def daily_counts(events: DataFrame, time: str, delay: str = "2 days") -> DataFrame:
    """Rows by day and source under a watermark, for late feeds."""
    stamped = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return stamped.groupBy(F.window(time, "1 day").alias("w"), "source").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "source", "n")
