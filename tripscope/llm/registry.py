"""Queries and DuckDB SQL of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripscope.llm import (
    adaptive_rules, alignment, block_naming, digests, importance, language_id, line_dedup, mixing, packing, quality, revisits,
    secret_scan, setsketch,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secret_scan.op1_secret_scan,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_block_naming": block_naming.op3_block_naming,
        "op4_revisits": revisits.op4_revisits,
        "op5_packing": packing.op5_packing,
        "op6_setsketch": setsketch.op6_setsketch,
        "op7_digests": digests.op7_digests,
        "op8_quality": quality.op8_quality,
        "op9_language": language_id.op9_language,
        "op10_mixing": mixing.op10_mixing,
        "op11_importance": importance.op11_importance,
        "op12_alignment": alignment.op12_alignment,
        "op13_adaptive_rules": adaptive_rules.op13_adaptive_rules,
    }


def oracle_sql() -> dict[str, str]:
    """Keys without an entry have no SQL form; they are tested against
    brute force, a round trip or held-out accuracy in ``tests/llm``."""
    return {
        "op3_block_naming": block_naming.OP3_SQL,
        "op4_revisits": revisits.OP4_SQL,
        "op11_importance": importance.OP11_SQL,
        "op13_adaptive_rules": adaptive_rules.OP13_SQL,
    }
