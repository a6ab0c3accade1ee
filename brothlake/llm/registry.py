"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ann, bpe, langid, mixing, ngram_join, periodic, prefix_bpe, quality, substrings, tokencount, toxicity, warc, whitening

QUERIES = {
    "op1_token_counts": tokencount.query,
    "op2_bpe_codec": bpe.query,
    "op3_quality_rules": quality.query,
    "op4_toxicity": toxicity.query,
    "op5_language_id": langid.query,
    "op6_substring_dedup": substrings.query,
    "op7_source_mixing": mixing.query,
    "op8_nearest_neighbours": ann.query,
    "op9_warc": warc.query,
    "op10_ngram_jaccard": ngram_join.query,
    "op11_periodic_runs": periodic.query,
    "op12_byte_bpe": prefix_bpe.query,
    "op13_embedding_whitening": whitening.query,
}

ORACLES = {
    "op3_quality_rules": quality.ORACLE,
    "op6_substring_dedup": substrings.ORACLE,
    "op7_source_mixing": mixing.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_ngram_jaccard": ngram_join.ORACLE,
    "op11_periodic_runs": periodic.ORACLE,
}
