"""Training corpus: documents that are in a language, not toxic, one of each near-duplicate
group, free of benchmark passages, packed into windows.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with their
columns; the last returns the pieces of the packed windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorlake.llm import op1_toxicity, op3_jaccard_join, op4_language, op7_decontamination, op8_packing
from sensorlake.llm.common import ship, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)
    return run


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _shipped(op4_language.stage)),
    ("toxicity", _shipped(op1_toxicity.stage)),
    ("near_duplicates", _shipped(op3_jaccard_join.stage)),
    ("decontamination", _shipped(op7_decontamination.stage)),
    ("packing", _shipped(op8_packing.stage)),
]

#: The trained stages, the forest and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
