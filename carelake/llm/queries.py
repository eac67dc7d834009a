"""The registered queries of this package and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from carelake.llm import (
    decontaminate, html_text, langid, licenses, mixing, near_dedup, packing, quality, secrets, token_counts,
    toxicity, variants, whitening,
)

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_source_mixing": mixing.op2_source_mixing,
    "op3_token_packing": packing.op3_token_packing,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_html_text": html_text.op5_html_text,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_secret_scan": secrets.op11_secret_scan,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_spelling_variants": variants.op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op2_source_mixing": mixing.ORACLE,
    "op4_license_scan": licenses.ORACLE,
}
