"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from kindred.llm import (
    chat, decontaminate, near_dup, neighbours, packing, ppm, quality, runs, secret_scan, token_files, toxicity, warc,
    whitening,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_near_duplicates": near_dup.op2_near_duplicates,
    "op3_secret_scans": secret_scan.op3_secret_scans,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_token_files": token_files.op5_token_files,
    "op6_warc": warc.op6_warc,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_lm_scoring": ppm.op8_lm_scoring,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_nearest_neighbours": neighbours.op12_nearest_neighbours,
    "op13_periodic_runs": runs.op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_near_duplicates": near_dup.ORACLE,
    "op6_warc": warc.ORACLE,
    "op10_benchmark_decontamination": decontaminate.ORACLE,
}
