"""Checks on matrices and factors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import required
from pairloom.scratch import broadcast_if_small, stage

# Fixed value: a component whose cosine distance is above this counts as different.
COSINE_LIMIT = 0.01


def _side(matrix: DataFrame, name: str) -> DataFrame:
    """Cells with the count under another name; a null index or count fails the query."""
    # The indexes stay plain columns, so that a matrix that was just added up by cell is not shuffled again to be joined.
    i, j = (required(F.col(key), key) for key in ("i", "j"))
    count = F.when(i.isNotNull() & j.isNotNull(), required(F.col("count"), "count"))
    return matrix.select("i", "j", count.alias(name))


def matrix_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells that differ, ``(i, j, left_count, right_count)``; a missing cell is null on its side."""
    a, b = _side(left, "left_count"), _side(right, "right_count")
    return a.join(b, ["i", "j"], "full_outer").filter(~F.col("left_count").eqNullSafe(F.col("right_count")))


def range_digests(matrix: DataFrame, rows: int = 4096) -> DataFrame:
    """``(range, cells, sum, xor)``: a digest of the cells of each ``rows`` neighbouring rows, whatever their order.

    Digests of parts of a range add up (``cells`` and ``sum``, a decimal, by addition, ``xor`` by exclusive or), so they are summed
    before the shuffle and could be kept beside a matrix. Two hashes with different seeds feed the two.
    """
    side = _side(matrix, "count")
    key = F.expr(f"i div {int(rows)}").cast("int").alias("range")
    first, second = F.xxhash64("i", "j", "count"), F.xxhash64(F.lit(1), "count", "j", "i")
    return side.groupBy(key).agg(
        F.count(F.lit(1)).alias("cells"), F.sum(first.cast("decimal(20,0)")).alias("sum"), F.bit_xor(second).alias("xor")
    )


def matrix_diff_by_range(left: DataFrame, right: DataFrame, rows: int = 4096) -> DataFrame:
    """As :func:`matrix_diff`, but only the cells of row ranges whose digests differ are joined.

    Both matrices should be stored tables: they are read once for their digests, which are all that equal matrices
    shuffle, and once more for the ranges that differ. A range with other cells has the same digest only if two
    64-bit hashes, one summed and one by exclusive or, agree by chance.
    """
    a, b = (range_digests(side, rows).withColumnRenamed("range", f"r{k}") for k, side in enumerate((left, right)))
    same = (F.col("a.cells") == F.col("b.cells")) & (F.col("a.sum") == F.col("b.sum")) & (F.col("a.xor") == F.col("b.xor"))
    both = a.alias("a").join(b.alias("b"), F.col("r0") == F.col("r1"), "full_outer")
    differ = stage(both.filter(~F.coalesce(same, F.lit(False))).select(F.coalesce("r0", "r1").alias("range")), "diff-ranges")
    count = differ.count()
    if not count:
        return left.sparkSession.createDataFrame([], "i int, j int, left_count long, right_count long")
    wanted = broadcast_if_small(differ.df, count, 16)
    sides = [side.withColumn("range", F.expr(f"i div {int(rows)}").cast("int")).join(wanted, "range", "left_semi").drop("range") for side in (left, right)]
    return matrix_diff(*sides)


def diff_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row ``(cells, mismatches)`` over the union of the cells."""
    a, b = _side(left, "left_count"), _side(right, "right_count")
    same = F.col("left_count").eqNullSafe(F.col("right_count"))
    return a.join(b, ["i", "j"], "full_outer").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(~same).alias("mismatches")
    )


def compare_factors(left: DataFrame, right: DataFrame, limit: float = COSINE_LIMIT) -> DataFrame:
    """``(component, distance, failed)`` of two embedding tables, component by component.

    The distance is 1 - abs(cos), as the sign of a singular vector is arbitrary. A row that only one
    table has counts as zeros in the other.
    """
    a = left.select("i", F.col("features").alias("x"))
    b = right.select("i", F.col("features").alias("y"))
    zero = F.lit(0.0)

    def terms(x: Column, y: Column) -> Column:
        x, y = F.coalesce(x, zero), F.coalesce(y, zero)
        return F.struct((x * y).alias("xy"), (x * x).alias("xx"), (y * y).alias("yy"))

    # Joined row by row and taken apart afterwards, so the shuffle moves whole vectors.
    absent = F.array().cast("array<double>")
    paired = F.zip_with(F.coalesce("x", absent), F.coalesce("y", absent), terms)
    sums = (
        a.join(b, "i", "full_outer")
        .select(F.posexplode(paired).alias("component", "term"))
        .groupBy("component")
        .agg(F.sum("term.xy").alias("xy"), F.sum("term.xx").alias("xx"), F.sum("term.yy").alias("yy"))
    )
    cosine = F.col("xy") / F.nullif(F.sqrt(F.col("xx") * F.col("yy")), F.lit(0.0))
    distance = F.lit(1.0) - F.abs(F.coalesce(cosine, F.lit(0.0)))
    return sums.select("component", distance.alias("distance"), (distance > limit).alias("failed"))


def compare_subspaces(left: DataFrame, right: DataFrame, sigma: Sequence[float], gap: float = 0.01, limit: float = COSINE_LIMIT) -> DataFrame:
    """``(first, last, sigma, distance, failed)``: groups of components with near-equal ``sigma``, compared as subspaces.

    Vectors of nearly equal singular values may mix in two right results, while the space that they span may not. A group
    runs on while the next value is within ``gap`` of the one before, relative to it. Its distance is 1 minus the cosine of the largest
    principal angle between the two spans, whose cosines are the singular values of the product of orthonormal bases. All
    inner products are summed in one pass over the rows; the driver sees matrices whose sides are numbers of components. The last
    group of two truncated results may be cut apart differently, as components behind it are missing.
    """
    k = len(sigma)
    starts = [0, *[c for c in range(1, k) if sigma[c - 1] - sigma[c] > gap * sigma[c - 1]], k] if k else [0]
    groups = [(low, high) for low, high in zip(starts, starts[1:], strict=False)]
    a = left.select("i", F.col("features").alias("x"))
    b = right.select("i", F.col("features").alias("y"))
    rows = a.join(b, "i", "full_outer")
    zeros = F.array_repeat(F.lit(0.0), k)
    x, y = F.coalesce("x", zeros), F.coalesce("y", zeros)
    found = []
    for low, high in groups:
        width = high - low
        own = [F.slice(side, low + 1, width) for side in (x, y)]
        # Of both sides together, row by row, all products of two entries.
        both = F.concat(*own)
        products = F.flatten(F.transform(both, lambda p: F.transform(both, lambda q: p * q)))  # noqa: B023
        sums = rows.select(F.posexplode(products).alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
        square = np.zeros(4 * width * width)
        for row in sums.collect():
            square[row["at"]] = row["value"]
        square = square.reshape(2 * width, 2 * width)
        aa, ab, bb = square[:width, :width], square[:width, width:], square[width:, width:]
        halves = []
        for gram in (aa, bb):
            values, vectors = np.linalg.eigh(gram)
            halves.append(vectors / np.sqrt(np.maximum(values, 1e-300)) if values.min(initial=1.0) > 0 else np.zeros((width, width)))
        cosines = np.linalg.svd(halves[0].T @ ab @ halves[1], compute_uv=False)
        distance = float(1.0 - min(1.0, cosines.min(initial=1.0)))
        found.append((low, high - 1, float(sigma[low]), distance, distance > limit))
    return left.sparkSession.createDataFrame(found, "first int, last int, sigma double, distance double, failed boolean")


def cell_invariants(matrix: DataFrame, expected: Column) -> DataFrame:
    """One row ``(cells, diagonal, violations)``: how many cells break ``count = expected``."""
    return matrix.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("i") == F.col("j")).alias("diagonal"),
        F.count_if(~F.col("count").eqNullSafe(expected)).alias("violations"),
    )
