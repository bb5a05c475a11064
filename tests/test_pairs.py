from __future__ import annotations

import random
from collections import Counter

import pytest

import pairloom as pl
from pairloom.sources import generate_events

EVENTS = "PatientOrder long, NumDays int, WordIndex int"


def brute(events, window, scope=lambda row: None):
    counts = Counter()
    for x in range(len(events)):
        for y in range(x + 1, len(events)):
            a, b = events[x], events[y]
            if a[0] == b[0] and abs(a[1] - b[1]) <= window and scope(a) == scope(b):
                counts[min(a[2], b[2]), max(a[2], b[2])] += 1
    return dict(counts)


def as_dict(matrix):
    rows = matrix.collect()
    cells = {(r["i"], r["j"]): r["count"] for r in rows}
    assert len(cells) == len(rows)
    return cells


def count(spark, events, **options):
    return as_dict(pl.cooccurrence(spark.createDataFrame(events, EVENTS), **options))


def test_window_end_is_inclusive(spark):
    assert count(spark, [(1, 0, 5), (1, 30, 7)]) == {(5, 7): 1}
    assert count(spark, [(1, 0, 5), (1, 31, 7)]) == {}


def test_copies_and_repeated_words(spark):
    assert count(spark, [(1, 3, 5)] * 4) == {(5, 5): 6}
    assert count(spark, [(1, 3, 5), (1, 4, 5)]) == {(5, 5): 1}
    assert count(spark, [(1, 3, 9), (1, 3, 5), (1, 3, 9)]) == {(5, 9): 2, (9, 9): 1}


def test_empty_and_single(spark):
    assert count(spark, []) == {}
    assert count(spark, [(1, 3, 5)]) == {}


def test_wide_ids_and_negative_days(spark):
    big = 1 << 32
    assert count(spark, [(1, 0, 5), (1 + big, 0, 7)]) == {}
    assert count(spark, [(big, -40, 5), (big, -10, 7), (big, -9, 8)]) == {(5, 7): 1, (7, 8): 1}


@pytest.mark.parametrize("window", [0, 1, 3, 30])
@pytest.mark.parametrize("limit", [1, 5, 4096])
def test_against_brute_force(spark, window, limit):
    rng = random.Random(window * 10 + limit)
    # A third of the events belong to one patient.
    events = [(rng.choice([1, rng.randint(1, 9)]), rng.randint(-60, 60), rng.randint(0, 12)) for _ in range(300)]
    assert count(spark, events, window_days=window, max_group_rows=limit) == brute(events, window)


def test_dense_group_is_split(spark):
    rng = random.Random(5)
    events = [(1, rng.randint(0, 5), rng.randint(0, 40)) for _ in range(400)] + [(2, 0, 1), (2, 0, 2)]
    assert count(spark, events, max_group_rows=20) == brute(events, 30)


def test_scope(spark):
    events = [(1, 0, 5, "a"), (1, 1, 6, "a"), (1, 2, 7, "b"), (1, 3, 8, "b")]
    frame = spark.createDataFrame(events, EVENTS + ", input string")
    for limit in (1, 4096):
        apart = pl.cooccurrence(frame, scope=["input"], max_group_rows=limit)
        assert as_dict(apart) == brute(events, 30, lambda row: row[3])
    assert as_dict(pl.cooccurrence(frame)) == brute(events, 30)


def test_null_fails(spark):
    with pytest.raises(Exception, match="null in NumDays"):
        count(spark, [(1, None, 5), (1, 2, 7)])


def test_generated_events_against_brute_force(spark):
    frame = generate_events(spark, patients=12, events_per_patient=40)
    events = [tuple(r)[:3] for r in frame.collect()]
    assert len(events) == 480
    assert as_dict(pl.cooccurrence(frame)) == brute(events, 30)


def test_cells_of_busy_and_other_patients_are_added_once(spark):
    rows = [(1, day, day % 7) for day in range(40)] + [(2, 0, 1), (2, 3, 2)]
    events = spark.createDataFrame(rows, "PatientOrder long, NumDays int, WordIndex int")
    counts = pl.cooccurrence(events, window_days=7, max_group_rows=8)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(i") == 1
    want = pl.cooccurrence(events, window_days=7)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, want.collect()))
