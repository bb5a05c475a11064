"""Pointwise mutual information with context distribution smoothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import pmi_score, positive
from pairloom.operators.matrix import column_marginals, combine, fold, marginals, smoothed_total, symmetrize
from pairloom.scratch import Staged, broadcast_if_small, stage

# Index, marginal and the hash table's own overhead.
_MARGINAL_BYTES = 64


def pmi(
    matrix: DataFrame,
    alpha: float = 0.75,
    symmetric: bool = False,
    context: str = "row",
    on_zero_context: str = "error",
    merge_duplicates: bool = True,
) -> DataFrame:
    """PMI of every cell: ``(i, j, count, word_marginal, context_marginal, total, pmi)``.

    ``matrix`` is read twice, once for its marginals and once for its cells, so give a stored table.
    ``symmetric`` expands triangular input first. ``context`` takes the marginal of ``j`` from its
    row (``"row"``) or its column (``"column"``). A context without a marginal fails the query
    (``on_zero_context="error"``) or its cells are left out (``"drop"``). Equal (i, j) are summed
    first unless ``merge_duplicates`` is false, which saves a shuffle on input known to be unique.

    The marginals are one row per word: they are written once, counted, and broadcast only if
    small, so the matrix itself is not shuffled in the usual case.
    """
    if context not in ("row", "column"):
        raise ValueError(f"unknown context {context!r}")
    if on_zero_context not in ("error", "drop"):
        raise ValueError(f"unknown on_zero_context {on_zero_context!r}")
    words = stage(marginals(matrix, symmetric), "row-marginals")
    contexts = words
    if context == "column" and not symmetric:
        contexts = stage(column_marginals(matrix).withColumnRenamed("j", "i"), "column-marginals")
    total = smoothed_total(contexts.df, alpha).first()["smoothed_total"] or 0.0

    # Nulls have failed in the marginals, which read every cell.
    cells = matrix
    if merge_duplicates:
        # Both halves of a cell get the same sum, so it is made once, before the expansion.
        cells = combine(fold(matrix) if symmetric else matrix, rows=matrix.count())
    if symmetric:
        cells = symmetrize(cells)
    scored = cells.join(_lookup(words, "i", "word_marginal"), "i").join(
        _lookup(contexts, "j", "context_marginal"), "j", "left" if on_zero_context == "error" else "inner"
    )
    known = F.col("context_marginal")
    if on_zero_context == "error":
        message = F.concat(F.lit("context without marginal: "), F.col("j").cast("string"))
        known = F.coalesce(known, F.raise_error(message))
    scored = scored.withColumn("context_marginal", known).withColumn("total", F.lit(float(total)))
    score = pmi_score(F.col("count"), F.col("total"), F.col("word_marginal"), F.col("context_marginal"), alpha)
    return scored.select("i", "j", "count", "word_marginal", "context_marginal", "total", score.alias("pmi"))


def ppmi(
    matrix: DataFrame,
    alpha: float = 0.75,
    symmetric: bool = False,
    context: str = "row",
    on_zero_context: str = "error",
    merge_duplicates: bool = True,
    keep_zeros: bool = True,
) -> DataFrame:
    """Positive PMI ``(i, j, ppmi)``; arguments as in :func:`pmi`. Zero cells stay unless told otherwise."""
    scores = pmi(matrix, alpha, symmetric, context, on_zero_context, merge_duplicates)
    clipped = scores.select("i", "j", positive(F.col("pmi")).alias("ppmi"))
    return clipped if keep_zeros else clipped.filter(F.col("ppmi") > 0)


def explain_cell(scores: DataFrame, i: int, j: int) -> DataFrame:
    """One cell of a :func:`pmi` table with the numbers it is made of and its PPMI."""
    cell = scores.filter((F.col("i") == i) & (F.col("j") == j))
    return cell.withColumn("ppmi", positive(F.col("pmi")))


def _lookup(sums: Staged, key: str, name: str) -> DataFrame:
    table = sums.df.select(F.col("i").alias(key), F.col("marginal").alias(name)).filter(F.col(name) != 0)
    return broadcast_if_small(table, sums.count(), _MARGINAL_BYTES)
