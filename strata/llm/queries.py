"""The registered queries of this subpackage: one for each operator."""
from __future__ import annotations

from strata.llm.bit_planes import op7_token_output
from strata.llm.decontamination import op3_decontamination
from strata.llm import decontamination, hard_negatives, jaccard_join, source_audit
from strata.llm.hard_negatives import op11_hard_negatives
from strata.llm.jaccard_join import op10_jaccard_join
from strata.llm.language_id import op4_language_id
from strata.llm.license_scan import op2_license_scan
from strata.llm.ngram_lm import op1_lm_scoring
from strata.llm.packing import op6_packing
from strata.llm.pii import op9_pii
from strata.llm.quality_fm import op13_quality_classifier
from strata.llm.quality_rules import op5_quality_rules
from strata.llm.source_audit import op12_source_audit
from strata.llm.substring_dedup import op8_substring_dedup

_ALL = (
    op1_lm_scoring, op2_license_scan, op3_decontamination, op4_language_id, op5_quality_rules,
    op6_packing, op7_token_output, op8_substring_dedup, op9_pii, op10_jaccard_join,
    op11_hard_negatives, op12_source_audit, op13_quality_classifier,
)
LLM_QUERIES = {f.__name__: f for f in _ALL}

#: SQL for the operators that it can express whole; tests hold the others against brute force.
LLM_ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": decontamination.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_source_audit": source_audit.ORACLE_SQL,
}
