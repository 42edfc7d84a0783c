"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import op1_toxicity, op2_token_codes, op3_exact_dedup, op4_decontamination, op5_packing, op6_line_dedup, op7_chat, op8_host_reputation, op9_jaccard, op10_quality, op11_turn_repair, op12_spelling, op13_bloom_lm

_MODULES = {m.__name__.rpartition(".")[2]: m for m in (op1_toxicity, op2_token_codes, op3_exact_dedup, op4_decontamination, op5_packing, op6_line_dedup, op7_chat, op8_host_reputation, op9_jaccard, op10_quality, op11_turn_repair, op12_spelling, op13_bloom_lm)}

QUERIES = {name: getattr(m, name) for name, m in _MODULES.items()}
ORACLES = {name: m.SQL for name, m in _MODULES.items() if hasattr(m, "SQL")}
