from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm.vector_join import nearest_neighbours
from tests.llm import data

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    usable = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in usable.items():
        if q % 5:
            continue
        scores = []
        for c, b in usable.items():
            if c == q or len(a) != len(b):
                continue
            dot = sum(x * y for x, y in zip(a, b, strict=True))
            scores.append((-dot / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b)), c))
        out += [(q, rank, c, -score) for rank, (score, c) in enumerate(sorted((round(s, 12), c) for s, c in scores)[:k], 1)]
    return sorted(out)


def vectors(seed, count, dim):
    draw = random.Random(seed)
    rows = [(k, [draw.choice([-1.0, 0.5, 0.25, 2.0, 0.0]) + draw.choice([0, 0, draw.random()]) for _ in range(dim)]) for k in range(count)]
    same = [1.0] * dim
    rows += [(count + k, same) for k in range(60)]
    rows += [(1000, None), (1005, []), (1010, [0.0] * dim), (1015, [None, *same[1:]]), (1020, [math.nan, *same[1:]])]
    rows += [(1025, [math.inf, *same[1:]]), (None, same), (1030, [1e-30] * dim), (1035, [1e30, *[1.0] * (dim - 1)]), (1040, [1.0, 2.0])]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize(("seed", "count", "dim", "options"), [(1, 300, 8, {}), (2, 200, 3, {"block_rows": 16, "query_rows": 7, "group_blocks": 2})])
def test_against_brute_force(spark, seed, count, dim, options):
    rows = vectors(seed, count, dim)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    have = data.check_table(lambda table: nearest_neighbours(table, F.col("vec_id") % 5 == 0, k=4, **options), df)
    want = brute(rows, 4)
    assert [(r[0], r[1]) for r in have] == [(r[0], r[1]) for r in want] or sorted((r[0], r[1]) for r in have) == [(r[0], r[1]) for r in want]
    by_rank = {(r[0], r[1]): r for r in have}
    for query, rank, other, score in want:
        assert by_rank[query, rank][3] == pytest.approx(score, abs=1e-9)
        # Beyond rounding, ties go to the smaller id.
        if by_rank[query, rank][2] != other:
            same = [r for r in want if r[0] == query and abs(r[3] - score) < 1e-9]
            assert len(same) > 1 or rank == 4


def test_equal_vectors_go_by_id(spark):
    rows = [(k, [1.0, 2.0, 3.0], 0) for k in range(40)]
    have = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in have] == [1, 2, 3, 4, 5]


def test_few_candidates_and_repeated_ids(spark):
    """Every row is a candidate, also those that share an id, and every row that asks has its own ranks."""
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [3.0, 4.0], 0), (2, [-1.0, 0.0], 0)]
    have = nearest_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") == 0)
    ranked = [(1, 0, 1.0), (2, 2, 0.6), (3, 1, 0.0), (4, 2, -1.0)]
    want = sorted((0, *row) for row in ranked * 2)
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in have.collect()) == want


def test_the_nearer_row_of_a_repeated_id_is_found(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [1.0, 0.1], 0), (2, [1.0, 1.0], 0)]
    have = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=1).collect()
    assert [(r.query_id, r.vec_id, round(r.score, 3)) for r in have] == [(0, 1, 0.995)]
