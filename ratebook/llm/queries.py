"""Registered queries of the training-data operators, and their DuckDB twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratebook.llm import (
    bpe, chat_windows, class_lm, collocations, decontaminate, jaccard_join, line_dedup, pii, quality_rules, token_files,
    url_filter, vector_codes, warc_revisits,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_windows": chat_windows.op1_chat_windows,
    "op2_pii_pseudonyms": pii.op2_pii_pseudonyms,
    "op3_warc_revisits": warc_revisits.op3_warc_revisits,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_token_files": token_files.op10_token_files,
    "op11_collocations": collocations.op11_collocations,
    "op12_class_lm": class_lm.op12_class_lm,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc_revisits": warc_revisits.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
