"""Operators on count matrices ``(i, j, count)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import high, low, required

# Cells that one task adds up.
TASK_CELLS = 2_000_000


def _cells(matrix: DataFrame) -> DataFrame:
    """The cells; a null index or count fails the query.

    The count stands for the whole cell, so that nothing is pruned away by operators that read one index. The
    indexes stay plain columns, so that a table that is bucketed by one of them needs no shuffle for it.
    """
    i, j = (required(F.col(name), name) for name in ("i", "j"))
    count = F.when(i.isNotNull() & j.isNotNull(), required(F.col("count"), "count"))
    return matrix.select("i", "j", count.alias("count"))


def combine(*matrices: DataFrame, rows: int | None = None) -> DataFrame:
    """Sum of count matrices, for example of shards counted apart or loaded later.

    With ``rows``, the number of cells of all matrices together, they are dealt to tasks of about ``TASK_CELLS``, so a
    task's table of sums does not grow with the matrices.
    """
    cells = _cells(reduce(DataFrame.unionByName, matrices))
    if rows is not None and rows > TASK_CELLS:
        cells = cells.repartition(-(-rows // TASK_CELLS), "i", "j")
    return cells.groupBy("i", "j").agg(F.sum("count").alias("count"))


def fold(matrix: DataFrame) -> DataFrame:
    """Cells on the upper triangle, (j, i) as (i, j); equal cells are not added."""
    return _cells(matrix).select(low(F.col("i"), F.col("j")).alias("i"), high(F.col("i"), F.col("j")).alias("j"), "count")


def symmetrize(matrix: DataFrame) -> DataFrame:
    """Expand a triangular matrix: off-diagonal cells are mirrored, diagonal counts doubled.

    One scan without shuffle. Input that already holds both (i, j) and (j, i) gives duplicate cells.
    """
    return _cells(matrix).selectExpr(
        """inline(CASE WHEN i <> j
                       THEN array(struct(i, j, count), struct(j AS i, i AS j, count))
                       ELSE array(struct(i, j, count * 2 AS count)) END)"""
    )


def marginals(matrix: DataFrame, symmetric: bool = False) -> DataFrame:
    """Row sums ``(i, marginal)``; with ``symmetric`` those of the expanded triangular matrix."""
    cells = symmetrize(matrix) if symmetric else _cells(matrix)
    return cells.groupBy("i").agg(F.sum("count").alias("marginal"))


def column_marginals(matrix: DataFrame) -> DataFrame:
    """Column sums ``(j, marginal)``."""
    return _cells(matrix).groupBy("j").agg(F.sum("count").alias("marginal"))


def smoothed_total(sums: DataFrame, alpha: float = 0.75) -> DataFrame:
    """One row ``(smoothed_total)``: sum of the marginals raised to ``alpha``."""
    power = F.pow(F.col("marginal").cast("double"), F.lit(float(alpha)))
    return sums.agg(F.sum(power).alias("smoothed_total"))


def total_count(matrix: DataFrame) -> DataFrame:
    """One row ``(total)``: sum of all counts."""
    return _cells(matrix).agg(F.sum("count").alias("total"))


def matrix_order(matrix: DataFrame) -> DataFrame:
    """One row ``(n)``: highest index of either axis plus one; null for an empty matrix."""
    index = [required(F.col(name), name).alias(name) for name in ("i", "j")]
    return matrix.select(*index).agg((F.greatest(F.max("i"), F.max("j")) + 1).alias("n"))


def row_slice(matrix: DataFrame, start: int, end: int) -> DataFrame:
    """Cells of the rows ``start <= i < end``; the bounds reach the Parquet scan."""
    return matrix.filter((F.col("i") >= start) & (F.col("i") < end))
