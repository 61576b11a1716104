"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pressmill.llm import alignment, exact_dedup, html_text, imatch, near_dedup, packing, passages, pieces, pii, quality, repeats, spelling, toxicity


def queries() -> dict:
    return {
        "op1_html_extraction": html_text.op1_html_extraction,
        "op10_sentencepiece": pieces.op10_sentencepiece,
        "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_substring_dedup": passages.op13_substring_dedup,
        "op2_document_fingerprints": imatch.op2_document_fingerprints,
        "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
        "op4_suffix_array_dedup": repeats.op4_suffix_array_dedup,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_best_fit_packing": packing.op6_best_fit_packing,
        "op7_exact_dedup": exact_dedup.op7_exact_dedup,
        "op8_quality_classifier": quality.op8_quality_classifier,
        "op9_private_data": pii.op9_private_data,
    }


def oracle_sql() -> dict[str, str]:
    return {"op13_substring_dedup": passages.OP13_SQL, "op7_exact_dedup": exact_dedup.OP7_SQL}
