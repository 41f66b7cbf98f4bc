"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_toxicity,
    op2_extraction,
    op3_jaccard_join,
    op4_language,
    op5_token_files,
    op6_sharding,
    op7_decontamination,
    op8_packing,
    op9_topk,
    op10_warc,
    op11_lexical,
    op12_hamming,
    op13_runs,
)
from .common import ship


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {
    "op1_crf_toxicity": _shipped(op1_toxicity.query),
    "op2_boosted_extraction": _shipped(op2_extraction.query),
    "op3_jaccard_forest_join": _shipped(op3_jaccard_join.query),
    "op4_ecoc_language": _shipped(op4_language.query),
    "op5_token_files": _shipped(op5_token_files.query),
    "op6_hash_tree_sharding": op6_sharding.query,
    "op7_positional_decontamination": _shipped(op7_decontamination.query),
    "op8_window_packing": _shipped(op8_packing.query),
    "op9_bit_sliced_topk": _shipped(op9_topk.query),
    "op10_warc_chunks": _shipped(op10_warc.query),
    "op11_stratified_search": _shipped(op11_lexical.query),
    "op12_multi_index_hashing": _shipped(op12_hamming.query),
    "op13_grammar_runs": _shipped(op13_runs.query),
}

ORACLES = {
    "op7_positional_decontamination": op7_decontamination.ORACLE,
    "op9_bit_sliced_topk": op9_topk.ORACLE,
    "op10_warc_chunks": op10_warc.ORACLE,
    "op11_stratified_search": op11_lexical.ORACLE,
}
