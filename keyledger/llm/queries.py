"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from keyledger.llm import (
    embeddings, exact_dedup, kneser_ney, licences, mixing, packing, periodic, quality, secrets, sharding, simhash,
    spelling, suffix_dedup,
)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_suffix_array_dedup": suffix_dedup.op2_suffix_array_dedup,
    "op3_mixing": mixing.op3_mixing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_lm_scoring": kneser_ney.op7_lm_scoring,
    "op8_packing": packing.op8_packing,
    "op9_licence_scan": licences.op9_licence_scan,
    "op10_embedding_near_dedup": embeddings.op10_embedding_near_dedup,
    "op11_sharding": sharding.op11_sharding,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE_SQL = {
    "op1_secret_scan": secrets.ORACLE,
    "op2_suffix_array_dedup": suffix_dedup.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op9_licence_scan": licences.ORACLE,
    "op10_embedding_near_dedup": embeddings.ORACLE,
}
