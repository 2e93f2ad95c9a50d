"""The corpus operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, html, packing, phrases, quality, simhash, substring, tokenfile, topk, toxicity, warc, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring.op1_repeats,
        "op2_simhash_neardup": simhash.op2_simhash,
        "op3_byte_bpe": bpe.op3_bpe,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_nra_topk": topk.op5_topk,
        "op6_warc_roundtrip": warc.op6_warc,
        "op7_token_files": tokenfile.op7_token_files,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_quality": quality.op9_quality,
        "op10_html_text": html.op10_html,
        "op11_whitening": whitening.op11_whitening,
        "op12_packing": packing.op12_packing,
        "op13_phrases": phrases.op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_nra_topk": topk.ORACLE, "op8_decontaminate": decontaminate.ORACLE, "op13_phrases": phrases.ORACLE}
