"""The subpackage's queries and their SQL, for the entry module."""

from __future__ import annotations

from .chat_format import op9_chat_formatting
from .fingerprints import op7_fingerprints
from .language import op1_language_id
from .lm_score import ORACLE_OP2, op2_lm_score
from .mixing import ORACLE_OP3, op3_mix_sources
from .ngram_join import op4_ngram_join
from .packing import op5_best_fit_packing
from .quality import ORACLE_OP8, op8_quality_rules
from .toxicity import op10_toxicity
from .warc import ORACLE_OP6, op6_warc

QUERIES = {
    "op4_ngram_join": op4_ngram_join,
    "op2_lm_score": op2_lm_score,
    "op7_fingerprints": op7_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op1_language_id": op1_language_id,
    "op6_warc": op6_warc,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op3_mix_sources": op3_mix_sources,
    "op9_chat_formatting": op9_chat_formatting,
}
ORACLES = {"op2_lm_score": ORACLE_OP2, "op6_warc": ORACLE_OP6, "op3_mix_sources": ORACLE_OP3, "op8_quality_rules": ORACLE_OP8}
