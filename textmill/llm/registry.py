"""The queries of this subpackage and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from textmill.llm import alignment, ball_kmeans, decontaminate, neardup, ngram, packing, prefix_counts, quality_model, quality_rules, secrets, sharding, substring_dedup, toxicity

QUERIES = {
    "op4_column_suffixes": substring_dedup.op4_column_suffixes,
    "op7_elias_fano_trie": ngram.op7_elias_fano_trie,
    "op5_additive_model": quality_model.op5_additive_model,
    "op9_crf_spans": toxicity.op9_crf_spans,
    "op10_lsh_forest": neardup.op10_lsh_forest,
    "op8_credential_links": secrets.op8_credential_links,
    "op1_distribution_divergence": quality_rules.op1_distribution_divergence,
    "op6_winnowing": decontaminate.op6_winnowing,
    "op3_minimum_bin_slack": packing.op3_minimum_bin_slack,
    "op2_bounded_ring": sharding.op2_bounded_ring,
    "op11_dangling_suffix": alignment.op11_dangling_suffix,
    "op12_ball_kmeans": ball_kmeans.op12_ball_kmeans,
    "op13_prefix_counts": prefix_counts.op13_prefix_counts,
}

ORACLES: dict[str, str] = {
    "op10_lsh_forest": neardup.OP10_SQL,
    "op1_distribution_divergence": quality_rules.OP1_SQL,
    "op6_winnowing": decontaminate.OP6_SQL,
}
