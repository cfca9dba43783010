"""The corpus pipeline: language ID, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept, and returns the columns of documents; the last returns the packing plan.

- language: documents without letters, or without a language that holds half of
  their letters, go; lang becomes the predicted language of the others.
- near_duplicates: the document with the smallest id of each component stays.
- decontamination: documents that hold a benchmark passage go.
- personal_data: spans are replaced by their kind in angle brackets; n_chars follows.
- packing: bucket, batch and place of every document.

Nulls and empty tables pass as the operators define them; extra columns are kept
by all stages but the last. The tables that stages make on the way are deleted as
soon as the next stage's rows are written; run() leaves its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from furrow.llm import stages
from furrow.llm.common import materialise, read_table, tidy
from furrow.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.keep_first_of_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Language models, metric joins and the CRF have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    with tidy() as kept:
        for name, stage in STAGES:
            with tidy() as own:
                docs = materialise(stage(spark, docs, sf_dir), name)
                own.append(docs)
        kept.append(docs)
    return docs
