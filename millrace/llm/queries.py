"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

_OPS = {
    "op1_language_id": "language",
    "op2_document_fingerprints": "fingerprints",
    "op3_mix_sources": "mixing",
    "op4_toxicity": "toxicity",
    "op5_benchmark_decontamination": "decontaminate",
    "op6_secret_scan": "secrets",
    "op7_token_files": "tokenfile",
    "op8_warc_archive": "warc",
    "op9_simhash_near_dups": "simhash",
    "op10_suffix_array_dedup": "repeats",
    "op11_conversation_repair": "conversations",
    "op12_embedding_whitening": "whitening",
    "op13_line_dedup": "lines",
}


def queries() -> dict:
    return {name: getattr(import_module(f"millrace.llm.{module}"), name) for name, module in _OPS.items()}


def oracle_sql() -> dict[str, str]:
    from . import conversations, lines, mixing, warc

    return {"op3_mix_sources": mixing.ORACLE_SQL, "op8_warc_archive": warc.ORACLE_SQL, "op11_conversation_repair": conversations.ORACLE_SQL, "op13_line_dedup": lines.ORACLE_SQL}
