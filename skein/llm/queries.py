"""Registered queries of the training-data operators and their SQL where SQL can say it."""

from __future__ import annotations

from skein.llm import (centroid_clusters, conversation_repair, decontaminate, exact_dedup, line_dedup, lm_score, packing,
                       quality_rules, secret_scan, simhash_dups, substring_dedup, token_counts, url_filter)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_packing": packing.op4_packing,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_simhash_dups": simhash_dups.op6_simhash_dups,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_lm_score": lm_score.op8_lm_score,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_centroid_clusters": centroid_clusters.op11_centroid_clusters,
    "op12_exact_dedup": exact_dedup.op12_exact_dedup,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE_SQL = {"op2_line_dedup": line_dedup.OP2_SQL, "op7_decontaminate": decontaminate.OP7_SQL,
              "op11_centroid_clusters": centroid_clusters.OP11_SQL, "op12_exact_dedup": exact_dedup.OP12_SQL,
              "op13_conversation_repair": conversation_repair.OP13_SQL}
