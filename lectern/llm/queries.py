"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from lectern.llm import decontamination, exact_dedup, license_scan, lm_scoring, ngram_join, sharding, source_mixing, token_store, toxicity, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_source_mixing": source_mixing.op4_source_mixing,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_warc": warc.op6_warc,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_token_output": token_store.op8_token_output,
    "op9_sharding": sharding.op9_sharding,
    "op10_decontamination": decontamination.op10_decontamination,
}
ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op4_source_mixing": source_mixing.OP4_SQL,
    "op5_license_scan": license_scan.OP5_SQL,
    "op6_warc": warc.OP6_SQL,
}
