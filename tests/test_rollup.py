from __future__ import annotations

import random
from collections import Counter

import pytest

import pairloom as pl
from pairloom.operators import rollup as rollup_module

MATRIX = "i int, j int, count long"
MAPPING = "WordIndex long, Source long, Code string"


def test_dense_index_is_in_byte_order(spark):
    codes = ["b", "B", "a", "é", "zz", "a", "Z", "", "10", "9"]
    mapping = spark.createDataFrame([(n, 1, c) for n, c in enumerate(codes)], MAPPING)
    have = {r["Code"]: r["NewIndex"] for r in pl.dense_index(mapping).collect()}
    assert have == {c: n for n, c in enumerate(sorted(set(codes), key=lambda c: c.encode()))}


def test_dense_index_over_many_partitions(spark):
    rng = random.Random(3)
    codes = sorted({f"{rng.randrange(10**9):x}" for _ in range(3000)})
    mapping = spark.createDataFrame([(n, 1, c) for n, c in enumerate(codes)], MAPPING)
    rows = pl.dense_index(mapping.repartition(16)).collect()
    assert {r["Code"]: r["NewIndex"] for r in rows} == {c: n for n, c in enumerate(codes)}


def test_dense_index_of_nothing(spark):
    assert pl.dense_index(spark.createDataFrame([], MAPPING)).count() == 0


def test_last_row_wins(spark):
    rows = [(1, 1, "x", 10), (1, 2, "y", 30), (1, 5, "z", 20), (2, 3, "x", 1)]
    mapping = spark.createDataFrame(rows, MAPPING + ", line int")
    have = sorted(map(tuple, pl.dedupe_mapping(mapping, "line").collect()))
    assert have == [(1, 2, "y"), (2, 3, "x")]


def test_stats(spark):
    mapping = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "x")], MAPPING)
    assert tuple(pl.mapping_stats(mapping).first()) == (2, 2)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rollup_against_brute_force(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(rollup_module, "broadcast_if_small", lambda df, rows, row_bytes: df)
    rng = random.Random(11)
    mapping = [(w, rng.randint(0, 6), f"c{rng.randint(0, 9)}") for w in range(60)]
    cells = [(rng.randint(0, 70), rng.randint(0, 70), rng.randint(1, 5)) for _ in range(500)]
    index = {c: n for n, c in enumerate(sorted({m[2] for m in mapping}))}
    kept = {w: index[c] for w, s, c in mapping if s in (1, 2, 5)}
    want = Counter()
    for i, j, count in cells:
        if i in kept and j in kept:
            want[min(kept[i], kept[j]), max(kept[i], kept[j])] += count
    result = pl.rollup(spark.createDataFrame(cells, MATRIX), spark.createDataFrame(mapping, MAPPING))
    assert result.dtypes == [("i", "int"), ("j", "int"), ("count", "bigint")]
    assert {(r["i"], r["j"]): r["count"] for r in result.collect()} == dict(want)


def test_index_counts_codes_that_are_not_kept(spark):
    mapping = spark.createDataFrame([(0, 9, "a"), (1, 1, "b"), (2, 1, "c")], MAPPING)
    matrix = spark.createDataFrame([(1, 2, 4), (0, 1, 8)], MATRIX)
    assert [tuple(r) for r in pl.rollup(matrix, mapping).collect()] == [(1, 2, 4)]


def test_codes_of_overruled_rows_are_counted(spark):
    mapping = spark.createDataFrame([(1, 1, "a", 1), (1, 1, "b", 2)], MAPPING + ", line int")
    matrix = spark.createDataFrame([(1, 1, 4)], MATRIX)
    assert [tuple(r) for r in pl.rollup(matrix, mapping, order_col="line").collect()] == [(1, 1, 4)]
