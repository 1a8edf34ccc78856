"""Cleaning pipeline over ``documents``: five stages, each on all rows its predecessor kept.

quality keeps what the quality classifier predicts as good; near_duplicates
keeps one document of each group of near-copies; decontamination drops
documents that hold a benchmark item; personal_data replaces personal data in
the texts; pieces adds the SentencePiece ids. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import load, materialise
from strata.llm.decontamination import decontamination_stage
from strata.llm.jaccard_join import near_duplicate_stage
from strata.llm.pii import redaction_stage
from strata.llm.quality_classifier import quality_stage
from strata.llm.sentencepiece_fst import pieces_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", redaction_stage),
    ("pieces", pieces_stage),
]

# SQL can express none of the model stages; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; every stage's result is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
