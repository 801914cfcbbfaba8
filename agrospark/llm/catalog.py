"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from agrospark.llm import (
    bpe, chat, collocations, decontaminate, line_templates, lm_scoring, merkle, minhash, pii, quality, simple8b,
    suffix_repeats, twins, url_filter,
)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_suffix_repeats": suffix_repeats.op2_suffix_repeats,
    "op3_pii": pii.op3_pii,
    "op4_bpe": bpe.op4_bpe,
    "op5_simple8b": simple8b.op5_simple8b,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_quality": quality.op7_quality,
    "op8_line_templates": line_templates.op8_line_templates,
    "op9_minhash": minhash.op9_minhash,
    "op10_chat": chat.op10_chat,
    "op11_collocations": collocations.op11_collocations,
    "op12_merkle": merkle.op12_merkle,
    "op13_url_filter": url_filter.op13_url_filter,
}

SQL: dict[str, str] = twins.SQL
