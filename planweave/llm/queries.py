"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

_QUERIES = {
    "op1_language_id": "language",
    "op2_ngram_jaccard_join": "ngram_join",
    "op3_benchmark_decontamination": "decontaminate",
    "op4_quality_rules": "quality",
    "op5_sentencepiece": "pieces",
    "op6_suffix_array_dedup": "suffix_dedup",
    "op7_token_output": "token_output",
    "op8_license_scans": "licenses",
    "op9_secret_scans": "secrets",
    "op10_chat_formatting": "chat",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    chat, sql = (import_module(f"{__package__}.{name}") for name in ("chat", "sql"))
    return {"op2_ngram_jaccard_join": sql.NGRAM_JOIN, "op6_suffix_array_dedup": sql.REPEATS, "op8_license_scans": sql.LICENSES, "op10_chat_formatting": chat.SQL}
