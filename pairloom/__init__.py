"""Concept co-occurrence, PPMI and truncated SVD as Spark DataFrame jobs."""

from pairloom.operators.incremental import added_pairs
from pairloom.operators.matrix import (
    combine,
    column_marginals,
    marginals,
    matrix_order,
    row_slice,
    smoothed_total,
    symmetrize,
    total_count,
)
from pairloom.operators.pairs import cooccurrence, count_pairs, daily_counts
from pairloom.operators.ppmi import explain_cell, pmi, ppmi
from pairloom.operators.rollup import dedupe_mapping, dense_index, mapping_stats, rollup
from pairloom.operators.svd import ConvergenceError, SvdResult, embeddings, reconstruct, svd, to_long
from pairloom.operators.validate import (
    cell_invariants,
    compare_factors,
    compare_subspaces,
    diff_summary,
    matrix_diff,
    matrix_diff_by_range,
    range_digests,
)

__all__ = [
    "ConvergenceError",
    "SvdResult",
    "added_pairs",
    "cell_invariants",
    "column_marginals",
    "combine",
    "compare_factors",
    "compare_subspaces",
    "cooccurrence",
    "count_pairs",
    "daily_counts",
    "dedupe_mapping",
    "dense_index",
    "diff_summary",
    "embeddings",
    "explain_cell",
    "mapping_stats",
    "marginals",
    "matrix_diff",
    "matrix_diff_by_range",
    "matrix_order",
    "pmi",
    "ppmi",
    "range_digests",
    "reconstruct",
    "rollup",
    "row_slice",
    "smoothed_total",
    "svd",
    "symmetrize",
    "to_long",
    "total_count",
]
