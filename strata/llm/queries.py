"""The operators as named queries, and their SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    jaccard_join,
    license_scan,
    pii,
    quality_classifier,
    quality_rules,
    runs,
    sentencepiece_fst,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_pii": pii.op4_pii,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_license_scans": license_scan.op6_license_scans,
    "op7_sentencepiece": sentencepiece_fst.op7_sentencepiece,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_sharding": sharding.op9_sharding,
    "op10_url_filters": url_filter.op10_url_filters,
    "op11_runs": runs.op11_runs,
    "op12_whitening": whitening.op12_whitening,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

ORACLE: dict[str, str] = {
    "op2_quality_rules": quality_rules.SQL,
    "op6_license_scans": license_scan.SQL,
    "op10_url_filters": url_filter.SQL,
}
