"""The registered queries of the subpackage and their DuckDB SQL, where SQL can express one."""

from __future__ import annotations

from fleetgauge.llm import (
    context_tree,
    exact_dedup,
    fingerprints,
    html_text,
    language_id,
    mixing,
    near_dedup,
    packing,
    simhash,
    target_sampling,
    token_files,
    toxicity,
    vector_codes,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_language_id": language_id.op3_language_id,
    "op4_mixing": mixing.op4_mixing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_fingerprints": fingerprints.op6_fingerprints,
    "op7_context_tree": context_tree.op7_context_tree,
    "op8_token_files": token_files.op8_token_files,
    "op9_near_dedup": near_dedup.op9_near_dedup,
    "op10_html_text": html_text.op10_html_text,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_target_sampling": target_sampling.op12_target_sampling,
    "op13_simhash": simhash.op13_simhash,
}
ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_target_sampling": target_sampling.ORACLE,
}
