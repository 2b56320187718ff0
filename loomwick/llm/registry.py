"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from loomwick.llm import decontamination, html_extraction, language_id, quality_classifier, quality_rules, sentencepiece_codec, simhash, suffix_dedup, token_output, url_filters

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": quality_classifier.query,
        "op2_decontamination": decontamination.query,
        "op3_token_output": token_output.query,
        "op4_language_id": language_id.query,
        "op5_sentencepiece": sentencepiece_codec.query,
        "op6_url_filters": url_filters.query,
        "op7_quality_rules": quality_rules.query,
        "op8_html_extraction": html_extraction.query,
        "op9_simhash": simhash.query,
        "op10_suffix_dedup": suffix_dedup.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontamination.ORACLE_SQL,
        "op6_url_filters": url_filters.ORACLE_SQL,
    }
