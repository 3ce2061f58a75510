"""The queries of this package and their SQL, for ``__spark_entry__``."""
from __future__ import annotations

import corpus_pipeline
from tessera.llm import alignment, best_fit_packing, decontaminate, hilbert_shards, jaccard_join, language_id, quality_rules, rule_ensemble, secret_scan, simhash, substring_dedup, token_files, whitening

QUERIES = {
    "op1_language_id": language_id.q_language_id,
    "op2_secret_scans": secret_scan.q_secrets,
    "op3_quality_rules": quality_rules.q_quality_rules,
    "op4_hilbert_shards": hilbert_shards.q_hilbert_shards,
    "op5_rule_ensemble": rule_ensemble.q_rule_ensemble,
    "op6_substring_dedup": substring_dedup.q_substring_dedup,
    "op7_ngram_jaccard_join": jaccard_join.q_jaccard_join,
    "op8_best_fit_packing": best_fit_packing.q_best_fit_packing,
    "op9_benchmark_decontamination": decontaminate.q_decontaminate,
    "op10_token_files": token_files.q_token_files,
    "op11_tokenizer_alignment": alignment.q_alignment,
    "op12_simhash": simhash.q_simhash,
    "op13_whitening": whitening.q_whitening,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op6_substring_dedup": substring_dedup.SQL,
    "op7_ngram_jaccard_join": jaccard_join.SQL,
    "op9_benchmark_decontamination": decontaminate.SQL,
}
