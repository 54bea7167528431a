"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codetables.llm import conversations, line_dedup, matroska, minhash, packing, pieces, quality_rules, search, secrets, sharding, substring_dedup, token_counts, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_secret_scans": secrets.op2_secret_scans,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_media_columns": matroska.op4_media_columns,
        "op5_substring_dedup": substring_dedup.op5_substring_dedup,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_sentencepiece": pieces.op8_sentencepiece,
        "op9_minhash_near_dedup": minhash.op9_minhash_near_dedup,
        "op10_best_fit_packing": packing.op10_best_fit_packing,
        "op11_conversation_repair": conversations.op11_conversation_repair,
        "op12_sharding": sharding.op12_sharding,
        "op13_ranked_search": search.op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_token_counts": token_counts.ORACLE,
        "op5_substring_dedup": substring_dedup.ORACLE,
        "op6_line_dedup": line_dedup.ORACLE,
        "op9_minhash_near_dedup": minhash.ORACLE,
        "op11_conversation_repair": conversations.ORACLE,
        "op12_sharding": sharding.ORACLE,
        "op13_ranked_search": search.ORACLE,
    }
