"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pitchline.llm import decontaminate, exact_dedup, id_files, language_id, lexical_search, minhash, packing, secrets, sharding, simhash, spelling, suffix_dedup, token_counts

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_language_id": language_id.op2_language_id,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_ring_sharding": sharding.op4_ring_sharding,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_id_files": id_files.op6_id_files,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op10_simhash": simhash.op10_simhash,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op11_minhash": minhash.op11_minhash,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
ORACLE = {
    "op5_decontamination": decontaminate.OP5_SQL,
    "op8_suffix_dedup": suffix_dedup.OP8_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op11_minhash": minhash.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
}
