"""Queries of this subpackage: name -> f(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from . import (
    alignment,
    decontaminate,
    exact_dedup,
    language_id,
    lexical,
    neighbours,
    ngram_join,
    packing,
    quality,
    repeats,
    secrets,
    sharding,
    token_counts,
)

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_language_id": language_id.query,
    "op3_decontamination": decontaminate.query,
    "op4_sharding": sharding.query,
    "op5_quality": quality.query,
    "op6_secret_scan": secrets.query,
    "op7_packing": packing.query,
    "op8_suffix_dedup": repeats.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_ngram_join": ngram_join.query,
    "op11_nearest_neighbours": neighbours.query,
    "op12_lexical_search": lexical.query,
    "op13_token_alignment": alignment.query,
}

ORACLES = {
    "op8_suffix_dedup": repeats.ORACLE_SQL,
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
}
