"""The training-data queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, extraction, jaccard, knn, lines, mixing, quality, secrets, sharding, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.op1_sharding,
    "op2_suffix_dedup": suffixes.op2_suffix_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_quality": quality.op7_quality,
    "op8_extraction": extraction.op8_extraction,
    "op9_secrets": secrets.op9_secrets,
    "op10_top_k": knn.op10_top_k,
}
ORACLES: dict[str, str] = {
    "op4_line_dedup": lines.ORACLE,
    "op5_jaccard_join": jaccard.ORACLE,
    "op9_secrets": secrets.ORACLE,
    "op10_top_k": knn.ORACLE,
}
