"""From raw documents to encoded training text, in stages that each use one corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farebox.llm import stages
from farebox.llm.frames import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("bpe_encoding", stages.bpe_encoding),
]

# no SQL says what a trained model or a merge table decides
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
