"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linfold.llm import (
    op1_fingerprint,
    op2_packing,
    op3_simhash,
    op4_rules,
    op5_substring,
    op6_suffix,
    op7_toxicity,
    op8_revisits,
    op9_bpe,
    op10_classifier,
    op11_lm,
    op12_repair,
    op13_negatives,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprint": op1_fingerprint.query,
    "op2_packing": op2_packing.query,
    "op3_simhash": op3_simhash.query,
    "op4_rules": op4_rules.query,
    "op5_substring": op5_substring.query,
    "op6_suffix": op6_suffix.query,
    "op7_toxicity": op7_toxicity.query,
    "op8_revisits": op8_revisits.query,
    "op9_bpe": op9_bpe.query,
    "op10_classifier": op10_classifier.query,
    "op11_lm": op11_lm.query,
    "op12_repair": op12_repair.query,
    "op13_negatives": op13_negatives.query,
}

ORACLE_SQL: dict[str, str] = {
    "op8_revisits": op8_revisits.ORACLE_SQL,
    "op13_negatives": op13_negatives.ORACLE_SQL,
}
