"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from augur.llm.decontaminate import op4_benchmark_decontamination
from augur.llm.language_id import op1_language_id
from augur.llm.mixing import op9_mixing_sources
from augur.llm.oracle import ORACLE_SQL
from augur.llm.pii import op6_pii_surrogates
from augur.llm.quality_classifier import op12_quality_classifier
from augur.llm.quality_rules import op7_quality_rules
from augur.llm.simhash_dedup import op3_simhash_dedup
from augur.llm.substring_dedup import op8_substring_dedup
from augur.llm.token_counts import op2_token_counts
from augur.llm.tool_calls import op5_tool_call_linking
from augur.llm.url_reputation import op10_url_reputation
from augur.llm.vector_codes import op11_vector_codes
from augur.llm.whitening import op13_embedding_whitening

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_tool_call_linking": op5_tool_call_linking,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing_sources": op9_mixing_sources,
    "op10_url_reputation": op10_url_reputation,
    "op11_vector_codes": op11_vector_codes,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_embedding_whitening": op13_embedding_whitening,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
