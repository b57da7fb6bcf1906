"""Registered names of the operators and their DuckDB SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = {
    "op1_byte_cnn_quality": "quality_cnn",
    "op2_bm25_decontamination": "decontaminate",
    "op3_ngram_jaccard_join": "jaccard",
    "op4_nearest_example_toxicity": "toxicity",
    "op5_hashed_maxent_lm": "maxent",
    "op6_frequency_ranked_ids": "token_files",
    "op7_boosted_quality_rules": "quality_rules",
    "op8_kd_tree_shards": "sharding",
    "op9_source_mix": "mixing",
    "op10_lstm_html_extract": "html_extract",
    "op11_best_fit_packing": "packing",
    "op12_best_position_search": "lexical_search",
    "op13_importance_resampling": "importance",
}


def _query(module: str) -> Callable[[SparkSession, str], DataFrame]:
    return importlib.import_module(f"zerobill.llm.{module}").query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {name: _query(module) for name, module in MODULES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(importlib.import_module(f"zerobill.llm.{m}"), "ORACLE_SQL", None) for name, m in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
