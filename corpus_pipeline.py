"""From raw documents to token ids: quality, repeated lines, near duplicates, benchmark leaks, encoding.

Each stage takes the documents its predecessor kept and returns documents; the last one returns the encoding of each
document kept. ``run`` writes every stage to the shared folder and reads it back, so a later stage never recomputes
an earlier one and a lost executor costs one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from venuelake.llm import stages
from venuelake.llm.common import stage, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", stages.quality),
    ("line_dedup", stages.lines),
    ("near_dedup", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("bpe", stages.encoding),
]

#: Trained models, sketches and tokenizers: SQL cannot express the stages. The tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
