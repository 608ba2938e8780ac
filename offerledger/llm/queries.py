"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: query name: the module that holds it
WHERE = {
    "op1_license_scan": "license_scan",
    "op2_toxicity": "toxicity",
    "op3_co_training": "co_training",
    "op4_html_extraction": "html_extraction",
    "op5_benchmark_decontamination": "decontamination",
    "op6_sentencepiece_codec": "sentencepiece_agenda",
    "op7_suffix_array_dedup": "suffix_dedup",
    "op8_quality_rules": "quality_rules",
    "op9_ngram_jaccard_join": "ngram_jaccard",
    "op10_orc_tokens": "orc_tokens",
    "op11_merkle_manifest": "merkle",
    "op12_source_mixing": "mixing",
    "op13_ranked_search": "ranked_search",
}
#: query name: the name of its SQL in its module
SQL = {"op11_merkle_manifest": "OP11_SQL", "op12_source_mixing": "OP12_SQL", "op13_ranked_search": "OP13_SQL"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"offerledger.llm.{module}"), name) for name, module in WHERE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"offerledger.llm.{WHERE[name]}"), sql) for name, sql in SQL.items()}
