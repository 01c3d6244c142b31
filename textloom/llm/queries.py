"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from textloom.llm import bpe, codes, lines, lm, minhash, negatives, packing, pieces, quotes, simhash, suffix, toxicity, vectors

QUERIES = {
    "op1_lm_scoring": lm.query,
    "op2_quotation_linking": quotes.query,
    "op3_minhash_fingerprints": minhash.query,
    "minhash_near_duplicates": minhash.classes,
    "op4_suffix_array_dedup": suffix.query,
    "op5_best_fit_packing": packing.query,
    "op6_simhash_near_dedup": simhash.query,
    "op7_line_dedup": lines.query,
    "op8_embedding_near_dedup": vectors.query,
    "op9_byte_bpe": bpe.query,
    "op10_toxicity": toxicity.query,
    "op11_hard_negatives": negatives.query,
    "op12_token_counts": pieces.query,
    "op13_vector_codes": codes.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_quotation_linking": quotes.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op13_vector_codes": codes.SQL,
}
