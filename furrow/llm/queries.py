"""The queries of the training-data operators and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from furrow.llm.decontaminate import op4_decontamination
from furrow.llm.html_extract import op6_html_extract
from furrow.llm.ivfpq import op5_ivfpq
from furrow.llm.jaccard_join import op9_jaccard_join, op9_sql
from furrow.llm.language import op3_language_id
from furrow.llm.licenses import op7_license_scan, op7_sql
from furrow.llm.lm_scoring import op1_lm_scoring, op1_sql
from furrow.llm.packing import op8_packing
from furrow.llm.pii import op2_pii
from furrow.llm.toxicity import op10_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_pii": op2_pii,
        "op3_language_id": op3_language_id,
        "op4_decontamination": op4_decontamination,
        "op5_ivfpq": op5_ivfpq,
        "op6_html_extract": op6_html_extract,
        "op7_license_scan": op7_license_scan,
        "op8_packing": op8_packing,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_toxicity": op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for those that it can express; the others are tested against brute force in tests/llm."""
    return {"op1_lm_scoring": op1_sql(), "op7_license_scan": op7_sql(), "op9_jaccard_join": op9_sql()}
