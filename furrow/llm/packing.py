"""Packing into optimal length buckets (operator 8).

The global histogram of lengths goes through a dynamic programme that chooses
the bucket boundaries with the least padding; inside each bucket, documents fill
batches up to a budget of padded tokens.

The histogram has every distinct length, so the optimum is exact; there are at most
about the square root of twice the tokens of all documents. Documents get dense
positions inside a bucket without one task seeing the bucket: a bucket is dealt into
slots by hash of id and length, the (few) slot sizes are summed up, and a document's
place is its slot's offset plus its place there. Rows of one id and length that would
fill more than a slot are dealt over several.

Defined cases: null text counts as empty; an empty text has length 0 and goes to
the first bucket; a document longer than the budget is a batch of its own; which
document of a bucket comes first is up to the hash; of equal choices of boundaries
the one with smaller bounds is taken; repeated rows and rows with a null id each get
a place; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.llm.common import materialise, maybe_broadcast, read_table

BUCKETS = 8
#: Padded tokens of a batch.
TOKEN_BUDGET = 65_536
SLOT_DOCS = 20_000


def word_count(text: Column) -> Column:
    """Words between ASCII white space; any other bigint column of token counts will do."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def boundaries(lengths: list[int], counts: list[int], k: int = BUCKETS) -> list[int]:
    """At most k upper bounds (the last is the greatest length) with the least padding in all; of equal choices the one with smaller bounds.

    cost(i, j) of a bucket over bins i..j-1 is its bound times its documents less their tokens. The best
    start of the last bucket moves up with j, so each layer is filled by divide and conquer.
    """
    if not lengths:
        return []
    x = np.array(lengths, dtype=np.float64)
    n = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.float64))])
    s = np.concatenate([[0], np.cumsum(x * np.array(counts, dtype=np.float64))])
    m = len(x)
    best = np.concatenate([[0], x * n[1:] - s[1:]])  # with one bucket
    starts = []
    for _ in range(1, min(k, m)):
        new, frm = best.copy(), np.zeros(m + 1, dtype=np.int64)
        todo = [(1, m, 0, m - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            cost = best[i] + x[mid - 1] * (n[mid] - n[i]) - (s[mid] - s[i])
            at = int(cost.argmin())
            new[mid], frm[mid] = cost[at], i[at]
            todo += [(lo, mid - 1, a, int(i[at])), (mid + 1, hi, int(i[at]), b)]
        best = new
        starts.append(frm)
    out, j = [], m
    for frm in reversed(starts):
        out.append(int(lengths[j - 1]))
        j = int(frm[j])
        if j == 0:
            break
    if j:
        out.append(int(lengths[j - 1]))
    return out[::-1]


def pack(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Rows (doc_id, n_tokens, bucket, bucket_len, batch, place) for docs (doc_id, text)."""
    spark = docs.sparkSession
    length = word_count(F.col("text")) if length is None else length
    sized = materialise(docs.select("doc_id", length.alias("n_tokens"), F.monotonically_increasing_id().alias("row")), "lengths")
    hist = sorted((r.n_tokens, r.n) for r in sized.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())  # distinct lengths, two numbers each
    if not hist:
        return spark.createDataFrame([], "doc_id bigint, n_tokens bigint, bucket int, bucket_len bigint, batch bigint, place int")
    bounds = boundaries([x for x, _ in hist], [n for _, n in hist], buckets)
    docs_in = [0] * len(bounds)
    for x, n in hist:
        docs_in[int(np.searchsorted(bounds, x))] += n
    table = spark.createDataFrame([(k, b, max(1, budget // max(b, 1)), -(-c // SLOT_DOCS)) for k, (b, c) in enumerate(zip(bounds, docs_in, strict=True))], "bucket int, bucket_len bigint, cap bigint, slots int")
    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in bounds[:-1]), F.lit(0))
    same = sized.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("rows")).where(F.col("rows") > SLOT_DOCS)
    same = same.select(F.col("doc_id").alias("same_id"), F.col("n_tokens").alias("same_tokens"), F.ceil(F.col("rows") / SLOT_DOCS).alias("parts"))
    sized = sized.join(maybe_broadcast(same), F.col("doc_id").eqNullSafe(F.col("same_id")) & (F.col("n_tokens") == F.col("same_tokens")), "left")
    part = F.coalesce(F.col("row") % F.col("parts"), F.lit(0))
    placed = sized.withColumn("bucket", bucket).join(F.broadcast(table), "bucket").withColumn("slot", F.pmod(F.xxhash64("doc_id", "n_tokens", part), F.col("slots")).cast("int"))
    totals = placed.groupBy("bucket", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("bucket", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("bucket", "slot").orderBy("doc_id", "n_tokens")
    at = placed.withColumn("nth", F.row_number().over(own) - 1).join(offsets, ["bucket", "slot"]).withColumn("at", F.col("offset") + F.col("nth"))
    return at.select("doc_id", "n_tokens", "bucket", "bucket_len", F.expr("at div cap").alias("batch"), (F.col("at") % F.col("cap")).cast("int").alias("place"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
