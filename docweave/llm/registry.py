"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from docweave.llm import chat, codebooks, jaccard, langid, mixing, packing, quality, rollup, secretscan, sharding, spelling, vectors, warc

QUERIES = {
    "op1_histogram_shards": sharding.op1_histogram_shards,
    "op2_ngram_jaccard_join": jaccard.op2_ngram_jaccard_join,
    "op3_token_counts": rollup.op3_token_counts,
    "op4_language_id": langid.op4_language_id,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_reply_trees": chat.op6_reply_trees,
    "op7_vector_near_duplicates": vectors.op7_vector_near_duplicates,
    "op8_warc_revisits": warc.op8_warc_revisits,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_vector_codes": codebooks.op11_vector_codes,
    "op12_secret_scan": secretscan.op12_secret_scan,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE_SQL = {
    "op3_token_counts": rollup.OP3_SQL,
    "op5_mix_sources": mixing.OP5_SQL,
    "op8_warc_revisits": warc.OP8_SQL,
    "op9_quality_rules": quality.OP9_SQL,
    "op11_vector_codes": codebooks.OP11_SQL,
    "op13_spelling_variants": spelling.OP13_SQL,
}
