"""Language-model scores over all words of the corpus, against the SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from furrow.llm import lm_scoring


def rows_of_sql(documents, labels):
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("labels", labels)
    return {r[0]: r[1:] for r in con.sql(lm_scoring.op1_sql()).fetchall()}


def test_all_words_against_the_sql(spark, monkeypatch, tmp_path):
    """More words than 2,048, in several chunks, files and buckets."""
    monkeypatch.setattr(lm_scoring, "BUCKET_ENTRIES", 5000)
    r = random.Random(5)
    docs = [(i, " ".join(f"w{int(r.paretovariate(0.3)) % 9000}" for _ in range(r.randint(1, 200)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " A b\tA\n"), (303, "onlyhere onlyhere")]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 3)] * 2, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {x[0]: x[1:] for x in lm_scoring.op1_lm_scoring(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    documents, labels = (con.sql(f"SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'").arrow().read_all() for t in ("documents", "labels"))
    want = rows_of_sql(documents, labels)
    assert len({w for _, t in docs for w in (t or "").lower().split()}) > 2046
    assert got.keys() == want.keys()
    for i, x in want.items():
        assert got[i] == pytest.approx(x, abs=2e-6)


def test_all_words_edge_cases(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None)], "doc_id long, text string").withColumn("score", F.lit("clash"))
    none = df.select("doc_id").limit(0)
    got = sorted((str(r.doc_id), r.n_tokens, round(r.ce_target, 6)) for r in lm_scoring.score(df, none).collect())
    assert got == [("1", 2, 1.609438), ("1", 2, 1.609438), ("2", 0, 0.0), ("None", 1, 1.609438)]  # uniform over 3 words, <unk> and <s>
    assert lm_scoring.score(df.limit(0), none).count() == 0
