"""The operators as registered queries over the test tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    conversation_trie,
    decontamination,
    language_id,
    line_dedup,
    lm_scoring,
    merkle_manifest,
    mixing,
    quality_rules,
    secret_scan,
    simhash_dedup,
    substring_dedup,
    token_counts,
    toxicity,
)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_token_counts": token_counts.query,
        "op2_simhash_near_dedup": simhash_dedup.query,
        "op3_line_dedup": line_dedup.query,
        "op4_lm_scoring": lm_scoring.query,
        "op5_substring_dedup": substring_dedup.query,
        "op6_mixing": mixing.query,
        "op7_quality_rules": quality_rules.query,
        "op8_benchmark_decontamination": decontamination.query,
        "op9_secret_scan": secret_scan.query,
        "op10_toxicity": toxicity.query,
        "op11_conversation_trie": conversation_trie.query,
        "op12_merkle_manifest": merkle_manifest.query,
        "op13_language_id": language_id.query,
        "pipeline": corpus_pipeline.run,
    }


def all_sql() -> dict[str, str]:
    return {
        "op11_conversation_trie": conversation_trie.sql(),
        "op12_merkle_manifest": merkle_manifest.sql(),
    }
