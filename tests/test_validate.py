from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import pairloom as pl
from pairloom.functions import cosine_distance

MATRIX = "i int, j int, count long"
VECTORS = "i int, features array<double>"


def test_matrix_diff_sees_both_sides(spark):
    left = spark.createDataFrame([(0, 1, 5), (1, 1, 2), (2, 3, 1)], MATRIX)
    right = spark.createDataFrame([(0, 1, 5), (1, 1, 3), (4, 4, 9)], MATRIX)
    rows = sorted(map(tuple, pl.matrix_diff(left, right).collect()))
    assert rows == [(1, 1, 2, 3), (2, 3, 1, None), (4, 4, None, 9)]
    assert tuple(pl.diff_summary(left, right).first()) == (4, 3)


def test_compare_factors(spark):
    left = spark.createDataFrame([(0, [1.0, 0.0, 1.0]), (1, [1.0, 1.0, 0.0])], VECTORS)
    right = spark.createDataFrame([(0, [-1.0, 0.0, 0.0]), (1, [-1.0, 2.0, 1.0])], VECTORS)
    rows = {r["component"]: r for r in pl.compare_factors(left, right).collect()}
    assert [rows[c]["failed"] for c in range(3)] == [False, False, True]
    assert rows[2]["distance"] == pytest.approx(1.0)


def test_compare_factors_of_different_shape(spark):
    left = spark.createDataFrame([(0, [3.0, 1.0])], VECTORS)
    right = spark.createDataFrame([(0, [3.0]), (1, [4.0])], VECTORS)
    rows = {r["component"]: r["distance"] for r in pl.compare_factors(left, right).collect()}
    assert rows[0] == pytest.approx(0.4) and rows[1] == 1.0


def test_diff_by_range(spark, monkeypatch):
    cells = [(i, j, i * j + 1) for i in range(90) for j in range(i, 90, 7)]
    other = [c for c in cells if c[0] != 41] + [(41, 41, 5), (88, 89, 3)]
    a, b = (spark.createDataFrame(rows, MATRIX).repartition(3) for rows in (cells, other))
    want = sorted(map(tuple, pl.matrix_diff(a, b).collect()), key=repr)
    for rows in (1, 10, 4096):
        assert sorted(map(tuple, pl.matrix_diff_by_range(a, b, rows).collect()), key=repr) == want
    # Digests of parts add up to those of the whole.
    whole = {r["range"]: tuple(r)[1:] for r in pl.range_digests(a, 16).collect()}
    parts = [pl.range_digests(spark.createDataFrame(cells[k::2], MATRIX), 16) for k in range(2)]
    summed = parts[0].unionByName(parts[1]).groupBy("range").agg(F.sum("cells"), F.sum("sum"), F.bit_xor("xor"))
    assert {r[0]: tuple(r)[1:] for r in summed.collect()} == whole
    # Equal matrices are never joined cell by cell.
    monkeypatch.setattr("pairloom.operators.validate.matrix_diff", None)
    assert pl.matrix_diff_by_range(a, a.orderBy("j"), 8).count() == 0
    assert pl.matrix_diff_by_range(a.limit(0), a.limit(0)).count() == 0


def test_compare_subspaces(spark):
    """Vectors of near-equal values may turn inside their space; vectors of others may not."""
    rng = np.random.default_rng(6)
    q, _ = np.linalg.qr(rng.standard_normal((30, 5)))
    turn, _ = np.linalg.qr(rng.standard_normal((3, 3)))
    turned = np.hstack([q[:, :1], q[:, 1:4] @ turn, -q[:, 4:]])
    sigma = [9.0, 5.0, 4.99, 4.97, 1.0]

    def table(a):
        return spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(a)], "i int, features array<double>")

    assert any(r["failed"] for r in pl.compare_factors(table(q), table(turned)).collect())
    groups = pl.compare_subspaces(table(q), table(turned), sigma).collect()
    assert [(r["first"], r["last"], r["failed"]) for r in groups] == [(0, 0, False), (1, 3, False), (4, 4, False)]
    assert max(abs(r["distance"]) for r in groups) < 1e-12
    mixed = turned.copy()
    mixed[:, 3] = (turned[:, 3] + turned[:, 4]) / 2**0.5
    again = pl.compare_subspaces(table(q), table(mixed), sigma).collect()
    assert [r["failed"] for r in again] == [False, True, False]
    assert abs(again[1]["distance"] - (1 - 0.5**0.5)) < 1e-9
    alone = pl.compare_subspaces(table(q), table(turned), sigma, gap=0.0).collect()
    assert [r["first"] for r in alone] == [0, 1, 2, 3, 4] and alone[1]["failed"]
    # Rows that one table lacks count as zeros; no components, no groups.
    assert pl.compare_subspaces(table(q), table(q[:20]), sigma).filter("failed").count() == 3
    assert pl.compare_subspaces(table(q[:, :0]), table(q[:, :0]), []).count() == 0


def test_cell_invariants(spark):
    matrix = spark.createDataFrame([(1, 2, 3), (2, 2, 4), (2, 3, 9)], MATRIX)
    row = pl.cell_invariants(matrix, (F.col("i") + F.col("j")).cast("bigint")).first()
    assert tuple(row) == (3, 1, 1)


def test_cosine_distance(spark):
    row = spark.sql("SELECT array(1D, 0D) AS a, array(1D, 1D) AS b")
    value = row.select(cosine_distance(F.col("a"), F.col("b"))).first()[0]
    assert value == pytest.approx(1 - 2**-0.5)


@pytest.mark.parametrize("row", [(None, 1, 6), (1, None, 6), (1, 2, None)])
@pytest.mark.parametrize(
    "operator",
    [
        pl.symmetrize,
        pl.marginals,
        lambda m: pl.marginals(m, symmetric=True),
        pl.column_marginals,
        pl.total_count,
        pl.combine,
        lambda m: pl.ppmi(m, symmetric=True),
        lambda m: pl.matrix_diff(m, m),
        lambda m: pl.diff_summary(m, m),
        lambda m: pl.rollup(m, m.sparkSession.createDataFrame([(1, 1, "a"), (2, 1, "b")], "WordIndex long, Source long, Code string")),
    ],
)
def test_nulls_in_a_matrix_fail(spark, operator, row):
    matrix = spark.createDataFrame([(1, 2, 3), row], "i int, j int, count long")
    with pytest.raises(Exception, match="null in"):
        operator(matrix).collect()


def test_cosine_of_a_zero_vector_is_null(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([], [])]
    table = spark.createDataFrame(rows, "a array<double>, b array<double>")
    have = [r[0] for r in table.select(cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert have[0] == pytest.approx(1 - 0.5**0.5) and have[1:] == [None, None]


def test_added_up_matrices_are_compared_where_they_are(spark):
    """Both sides come dealt by cell, so the join shuffles neither again."""
    cells = spark.createDataFrame([(1, 2, 3), (1, 2, 4), (2, 2, 1)], "i int, j int, count long")
    diff = pl.matrix_diff(pl.combine(cells), pl.combine(cells.filter("i = 1")).hint("merge"))
    assert diff._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert [tuple(r) for r in diff.collect()] == [(2, 2, 1, None)]
