"""Bucket boundaries over the exact lengths, though one document is very long."""

from pyspark.sql import functions as F

from furrow.llm import packing


def test_a_long_document_does_not_coarsen_the_lengths(spark):
    lengths = [1 + i * i % 97 for i in range(300)] + [8191, 8192, 1_000_000]
    docs = spark.createDataFrame([(i, "", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    got = packing.pack(docs, length=F.col("n")).collect()
    sizes = sorted(set(lengths))
    bounds = packing.boundaries(sizes, [lengths.count(n) for n in sizes])
    assert sorted({r.bucket_len for r in got}) == bounds
    assert all(r.bucket_len == min(b for b in bounds if b >= r.n_tokens) for r in got)
    assert len(got) == len(lengths)
