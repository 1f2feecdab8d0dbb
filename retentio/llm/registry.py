"""The queries of this subpackage and their SQL (where SQL can express them)."""

from __future__ import annotations

from . import (
    decontamination, html_text, jaccard_join, mixing, odd_sketches, perplexity, pii_tagger, quality_gam, sharding, suffix_dedup, token_counts,
    vector_codes, whitening,
)

QUERIES = {
    "op1_quality_gam": quality_gam.op1_quality_gam,
    "op2_perplexity": perplexity.op2_perplexity,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_sharding": sharding.op4_sharding,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op10_pii": pii_tagger.op10_pii,
    "op9_html_text": html_text.op9_html_text,
    "op11_whitening": whitening.op11_whitening,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_odd_sketches": odd_sketches.op13_odd_sketches,
}

SQL = {
    "op5_decontamination": decontamination.OP5_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
    "op13_odd_sketches": odd_sketches.OP13_SQL,
}
