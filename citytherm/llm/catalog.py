"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citytherm.llm import bpe, chat, collocation, crosstoken, decontaminate, fingerprint, htmltext, neardup, quality, suffixes, tokenfiles, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_near_duplicates": neardup.op2_near_duplicates,
    "op3_url_filter": urls.op3_url_filter,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_chat_format": chat.op5_chat_format,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_html_text": htmltext.op8_html_text,
    "op9_fingerprints": fingerprint.op9_fingerprints,
    "op10_quality": quality.op10_quality,
    "op11_token_files": tokenfiles.op11_token_files,
    "op12_collocations": collocation.op12_collocations,
    "op13_token_alignment": crosstoken.op13_token_alignment,
}
ORACLE: dict[str, str] = {
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op5_chat_format": chat.OP5_SQL,
}
