"""Corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, PII surrogates and tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of the documents; the last adds ids, n_tokens and lossless. Edge cases are those of the operators: null texts and texts
without letters go in the first stage; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from allelespan.llm._common import staged, table
from allelespan.llm.decontaminate import stage_decontaminate
from allelespan.llm.langid import stage_language_id
from allelespan.llm.pieces import stage_pieces
from allelespan.llm.pii import stage_pii
from allelespan.llm.simhash import stage_near_dedup

STAGES = [
    ("language_id", stage_language_id),
    ("near_dedup", stage_near_dedup),
    ("decontaminate", stage_decontaminate),
    ("pii", stage_pii),
    ("pieces", stage_pieces),
]

#: A fitted classifier, connected components and keyed hashes: not for SQL. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
