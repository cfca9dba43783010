"""Stage 2 of the pipeline: what it leaves on disk, and that texts are not shuffled to drop copies."""

from pathlib import Path

from pyspark.sql import functions as F
from test_brute_force import linked, words

from furrow.llm import common, jaccard_join, stages


def test_a_table_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    """They stayed until the driver happened to collect its garbage."""
    jvm = spark._jvm.org.apache.spark.SparkEnv.get()

    def shuffles():
        return {f for d in jvm.blockManager().diskBlockManager().localDirsString() for f in Path(d).rglob("shuffle_*")}

    before, was = shuffles(), spark.conf.get(common.CLEANUP, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert common.materialise(counted, "counted").count() == 7
    common.bitmap(counted, "k")
    common.maybe_broadcast(counted)
    assert not shuffles() - before
    assert spark.conf.get(common.CLEANUP, None) == was


def test_rows_are_told_apart_exactly(spark):
    """Hundreds of documents pass the first bitmap for one of the ids."""
    docs = spark.range(400_000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    docs = docs.union(docs.where("doc_id < 4"))
    held, others = common.parted(docs, spark.range(2, 400_001, 2).toDF("doc_id"))
    same = "count(*) n", "count(doc_id) ids", "sum(doc_id) s", "max(doc_id % 2) high", "min(doc_id % 2) low"
    assert tuple(held.selectExpr(*same).first()) == (200_000, 200_000, sum(range(2, 400_000, 2)) + 2, 0, 0)
    assert tuple(others.selectExpr(*same).first()) == (200_003, 200_002, sum(range(1, 400_000, 2)) + 4, 1, 1)


def test_many_copies_are_dropped_without_a_shuffle_of_texts(spark, monkeypatch):
    """Beyond BROADCAST_ROWS copies every text was shuffled and sorted."""
    import random

    monkeypatch.setattr(common.maybe_broadcast, "__defaults__", (3,))
    r = random.Random(5)
    texts = {i: words(r, 40) for i in range(20)}
    texts |= {i: texts[i % 20] for i in range(20, 60)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = stages.keep_first_of_group(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string"))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(x.doc_id for x in got.collect()) == sorted(set(linked(texts).values())) == list(range(20))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan
