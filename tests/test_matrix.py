from __future__ import annotations

import math

import pytest

import pairloom as pl

MATRIX_COLUMNS = "i int, j int, count long"
from pairloom.operators import ppmi as ppmi_module
from pairloom.sources import generate_matrix

MATRIX = "i int, j int, count long"
TRIANGLE = [(0, 0, 3), (0, 1, 4), (1, 2, 5), (2, 2, 1), (0, 3, 2)]


@pytest.fixture()
def triangle(spark):
    return spark.createDataFrame(TRIANGLE, MATRIX)


def cells(frame, value="count"):
    return sorted((r["i"], r["j"], r[value]) for r in frame.collect())


def expected_pmi(rows, alpha):
    word = {}
    for i, _, count in rows:
        word[i] = word.get(i, 0) + count
    total = sum(m**alpha for m in word.values())
    return {
        (i, j): math.log2(count * total / (word[i] * word[j] ** alpha)) if j in word else None for i, j, count in rows
    }


def mirrored(rows):
    return [(i, j, c * 2 if i == j else c) for i, j, c in rows] + [(j, i, c) for i, j, c in rows if i != j]


def test_symmetrize(triangle):
    assert cells(pl.symmetrize(triangle)) == sorted(mirrored(TRIANGLE))


def test_symmetrize_keeps_duplicates(spark):
    both = spark.createDataFrame([(1, 2, 3), (2, 1, 3)], MATRIX)
    assert cells(pl.symmetrize(both)) == [(1, 2, 3), (1, 2, 3), (2, 1, 3), (2, 1, 3)]


def test_symmetrize_generated_matrix(spark):
    matrix = generate_matrix(spark, 100)
    rows = matrix.collect()
    assert 1200 < len(rows) < 1800
    diagonal = sum(r["i"] == r["j"] for r in rows)
    assert all(r["count"] == r["i"] + r["j"] for r in rows)
    assert pl.symmetrize(matrix).count() == 2 * (len(rows) - diagonal) + diagonal


def test_sums(triangle):
    assert sorted(map(tuple, pl.marginals(triangle).collect())) == [(0, 9), (1, 5), (2, 1)]
    assert sorted(map(tuple, pl.marginals(triangle, True).collect())) == [(0, 12), (1, 9), (2, 7), (3, 2)]
    assert sorted(map(tuple, pl.column_marginals(triangle).collect())) == [(0, 3), (1, 4), (2, 6), (3, 2)]
    assert pl.total_count(triangle).first()["total"] == 15
    assert pl.matrix_order(triangle).first()["n"] == 4
    assert pl.smoothed_total(pl.marginals(triangle), 1.0).first()["smoothed_total"] == 15
    assert cells(pl.row_slice(triangle, 1, 2)) == [(1, 2, 5)]


def test_combine(triangle):
    assert cells(pl.combine(triangle, triangle, triangle)) == sorted((i, j, 3 * c) for i, j, c in TRIANGLE)


def test_order_of_empty_matrix(spark):
    assert pl.matrix_order(spark.createDataFrame([], MATRIX)).first()["n"] is None


@pytest.mark.parametrize("alpha", [0.75, 1.0])
@pytest.mark.parametrize("small_side", [True, False])
def test_pmi(triangle, alpha, small_side, monkeypatch):
    if not small_side:
        monkeypatch.setattr(ppmi_module, "_MARGINAL_BYTES", 1 << 40)
    want = expected_pmi(mirrored(TRIANGLE), alpha)
    have = {(r["i"], r["j"]): r["pmi"] for r in pl.pmi(triangle, alpha, symmetric=True).collect()}
    assert have == pytest.approx(want)
    clipped = {(r["i"], r["j"]): r["ppmi"] for r in pl.ppmi(triangle, alpha, symmetric=True).collect()}
    assert clipped == pytest.approx({key: max(0.0, value) for key, value in want.items()})
    positive = pl.ppmi(triangle, alpha, symmetric=True, keep_zeros=False)
    assert positive.count() == sum(value > 0 for value in want.values())


def test_zero_context(triangle):
    with pytest.raises(Exception, match="context without marginal: 3"):
        pl.pmi(triangle).collect()
    want = {key: value for key, value in expected_pmi(TRIANGLE, 0.75).items() if value is not None}
    have = {(r["i"], r["j"]): r["pmi"] for r in pl.pmi(triangle, on_zero_context="drop").collect()}
    assert have == pytest.approx(want)


def test_column_context(triangle):
    rows = {(r["i"], r["j"]): r for r in pl.pmi(triangle, context="column").collect()}
    total = sum(m**0.75 for m in (3, 4, 6, 2))
    assert rows[1, 2]["context_marginal"] == 6
    assert rows[1, 2]["pmi"] == pytest.approx(math.log2(5 * total / (5 * 6**0.75)))


def test_duplicates_are_added_first(spark, triangle):
    split = triangle.unionByName(triangle)
    double = spark.createDataFrame([(i, j, 2 * c) for i, j, c in TRIANGLE], MATRIX)
    merged, plain = (
        {(i, j): score for i, j, score in cells(pl.ppmi(frame, symmetric=True), "ppmi")} for frame in (split, double)
    )
    assert len(merged) == 8 and merged == pytest.approx(plain)


def test_zero_count_scores_zero(spark):
    matrix = spark.createDataFrame([(0, 1, 0), (1, 0, 4), (0, 0, 2), (1, 1, 3)], MATRIX)
    scores = {(r["i"], r["j"]): r["ppmi"] for r in pl.ppmi(matrix).collect()}
    assert scores[0, 1] == 0.0


def test_explain_cell(triangle):
    row = pl.explain_cell(pl.pmi(triangle, symmetric=True), 1, 2).collect()
    assert len(row) == 1
    assert (row[0]["count"], row[0]["word_marginal"], row[0]["context_marginal"]) == (5, 9, 7)
    assert row[0]["ppmi"] == max(0.0, row[0]["pmi"])


def test_bad_arguments(triangle):
    with pytest.raises(ValueError):
        pl.pmi(triangle, context="diagonal")
    with pytest.raises(ValueError):
        pl.pmi(triangle, on_zero_context="ignore")


def test_sums_are_dealt_by_the_number_of_cells(spark, monkeypatch):
    """A task adds up so many cells, whatever the matrices hold."""
    from pairloom.operators import matrix as operators

    monkeypatch.setattr(operators, "TASK_CELLS", 10)
    rows = [(k % 9, k % 7, 1) for k in range(95)]
    cells = spark.createDataFrame(rows, MATRIX_COLUMNS)
    total = pl.combine(cells, cells, rows=190)
    assert total.rdd.getNumPartitions() == 19
    want = {}
    for i, j, n in rows:
        want[i, j] = want.get((i, j), 0) + 2 * n
    assert {(r["i"], r["j"]): r["count"] for r in total.collect()} == want


def test_merged_scores_add_each_cell_once(spark):
    """Input with both halves is folded before it is added up and expanded afterwards."""
    full = pl.symmetrize(spark.createDataFrame([(0, 1, 3), (1, 1, 2), (1, 2, 5), (0, 2, 1), (0, 1, 4)], MATRIX_COLUMNS))
    have = {(r["i"], r["j"]): r["count"] for r in pl.pmi(full, symmetric=True).collect()}
    assert have == {(0, 1): 14, (1, 0): 14, (1, 1): 8, (1, 2): 10, (2, 1): 10, (0, 2): 2, (2, 0): 2}
    plan = pl.pmi(full, symmetric=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")
