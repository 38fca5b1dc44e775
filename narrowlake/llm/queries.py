"""Registered queries of the operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from narrowlake.llm import (
    alignment,
    frames,
    katz,
    licenses,
    line_dedup,
    mixing,
    near_vectors,
    nearest,
    packing,
    periodic_runs,
    secrets,
    shingle_join,
    toxicity,
)

QUERIES = {
    "op1_near_vectors": near_vectors.op1_near_vectors,
    "op2_licenses": licenses.op2_licenses,
    "op3_katz": katz.op3_katz,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_pack": packing.op6_pack,
    "op7_secrets": secrets.op7_secrets,
    "op8_token_files": frames.op8_token_files,
    "op9_shingle_join": shingle_join.op9_shingle_join,
    "op10_nearest": nearest.op10_nearest,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_alignment": alignment.op13_alignment,
}

ORACLES = {
    "op1_near_vectors": near_vectors.SQL,
    "op9_shingle_join": shingle_join.SQL,
    "op10_nearest": nearest.SQL,
    "op11_line_dedup": line_dedup.SQL,
}
