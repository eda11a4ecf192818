"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, licenses, lm, mixing, neardup, negatives, oracle, pii, quality, repair, topk, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_chat_format": chat.op4_chat_format,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_lm_score": lm.op6_lm_score,
    "op7_url_filter": urls.op7_url_filter,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_quality": quality.op9_quality,
    "op10_exact_topk": topk.op10_exact_topk,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_pii": pii.op13_pii,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": oracle.OP1,
    "op3_decontaminate": oracle.OP3,
    "op4_chat_format": oracle.OP4,
    "op5_near_duplicates": oracle.OP5,
    "op10_exact_topk": oracle.OP10,
    "op11_conversation_repair": oracle.OP11,
    "op12_hard_negatives": oracle.OP12,
    "op13_pii": oracle.OP13,
}
