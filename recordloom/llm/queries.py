"""Queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from recordloom.llm import exact, hosts, lexical, lines, minhash, mixing, packing, passages, quality, resampling, secrets, vectors, wavelet

QUERIES = {
    "op1_entropy_mix": mixing.op1,
    "op2_wavelet_files": wavelet.op2,
    "op3_content_sort": exact.op3,
    "op4_probminhash": minhash.op4,
    "op5_residual_packing": packing.op5,
    "op6_link_graph": hosts.op6,
    "op7_collinear_chains": passages.op7,
    "op8_neighbour_vote": quality.op8,
    "op9_markov_secrets": secrets.op9,
    "op10_collision_counts": vectors.op10,
    "op11_bloom_lines": lines.op11,
    "op12_nra_search": lexical.op12,
    "op13_median_resample": resampling.op13,
}

ORACLES = {
    "op3_content_sort": exact.OP3_SQL,
    "op10_collision_counts": vectors.OP10_SQL,
    "op11_bloom_lines": lines.OP11_SQL,
    "op12_nra_search": lexical.OP12_SQL,
    "op13_median_resample": resampling.OP13_SQL,
}
