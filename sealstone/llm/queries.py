"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from sealstone.llm import hard_negatives, line_dedup, log_bilinear, manifest, packing, quality_rules, sanitise, simhash, source_mix, token_attribution, topk_search, toxicity, url_templates

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_token_attribution": token_attribution.op2_token_attribution,
    "op3_mix_sources": source_mix.op3_mix_sources,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_branch_and_bound": topk_search.op5_branch_and_bound,
    "op6_best_two_fit": packing.op6_best_two_fit,
    "op7_pii": sanitise.op7_pii,
    "op8_url_templates": url_templates.op8_url_templates,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_simhash": simhash.op10_simhash,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_log_bilinear": log_bilinear.op12_log_bilinear,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}
SQL = {
    "op3_mix_sources": source_mix.OP3_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op5_branch_and_bound": topk_search.OP5_SQL,
    "op7_pii": sanitise.OP7_SQL,
    "op8_url_templates": url_templates.OP8_SQL,
    "op9_quality_rules": quality_rules.OP9_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op13_merkle_manifest": manifest.OP13_SQL,
}
