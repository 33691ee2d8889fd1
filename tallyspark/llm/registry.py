"""The queries of this subpackage, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (op1_line_frequency, op2_sainte_lague_mix, op3_site_style_tree, op4_multi_order_join, op5_rlz_dedup,
               op6_prefix_targets, op7_gam_quality, op8_simhash_decontam, op9_dfa_secrets, op10_merkle_audit,
               op11_jacobi_davidson, op12_coordinate_join, op13_spelling_variants)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": op1_line_frequency.query,
    "op2_sainte_lague_mix": op2_sainte_lague_mix.query,
    "op3_site_style_tree": op3_site_style_tree.query,
    "op4_multi_order_join": op4_multi_order_join.query,
    "op5_rlz_dedup": op5_rlz_dedup.query,
    "op6_prefix_targets": op6_prefix_targets.query,
    "op7_gam_quality": op7_gam_quality.query,
    "op8_simhash_decontam": op8_simhash_decontam.query,
    "op9_dfa_secrets": op9_dfa_secrets.query,
    "op10_merkle_audit": op10_merkle_audit.query,
    "op11_jacobi_davidson": op11_jacobi_davidson.query,
    "op12_coordinate_join": op12_coordinate_join.query,
    "op13_spelling_variants": op13_spelling_variants.query,
}

# The others can't be expressed: markup, a boosted model, fingerprints, spans
# of an automaton, eigenvectors. Their tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_line_frequency": op1_line_frequency.ORACLE_SQL,
    "op2_sainte_lague_mix": op2_sainte_lague_mix.ORACLE_SQL,
    "op4_multi_order_join": op4_multi_order_join.ORACLE_SQL,
    "op5_rlz_dedup": op5_rlz_dedup.ORACLE_SQL,
    "op6_prefix_targets": op6_prefix_targets.ORACLE_SQL,
    "op10_merkle_audit": op10_merkle_audit.ORACLE_SQL,
    "op12_coordinate_join": op12_coordinate_join.ORACLE_SQL,
    "op13_spelling_variants": op13_spelling_variants.ORACLE_SQL,
}
