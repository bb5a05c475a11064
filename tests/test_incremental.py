from __future__ import annotations

import random

import pytest

import pairloom as pl
from pairloom import plans
from tests.test_pairs import EVENTS, as_dict, brute


def history(seed, count=260, patients=5):
    """A third of all events are of one patient, many on one day; some are copies."""
    draw = random.Random(seed)
    out = []
    for k in range(count):
        patient = 0 if k % 3 == 0 else draw.randrange(patients)
        day = 40 if patient == 0 and draw.random() < 0.4 else draw.randrange(-20, 120)
        out.append((patient, day, draw.randrange(9)))
    return out + out[:20]


def event_files(spark, events, folder):
    rows = spark.createDataFrame([(p, d, w, 1) for p, d, w in events], "PatientOrder long, NumDays int, WordIndex int, window int")
    rows.write.parquet(folder)
    return folder


@pytest.mark.parametrize(("window", "limit"), [(30, 4096), (0, 3), (7, 3)])
def test_loads_equal_one_count(spark, window, limit):
    events = history(3)
    loads = [events[k::3] for k in range(3)] + [[]]
    known, total = spark.createDataFrame([], plans.DAILY), None
    for load in loads:
        added, daily = pl.added_pairs(known, spark.createDataFrame(load, EVENTS), window, max_group_rows=limit)
        total = added if total is None else pl.combine(total, added)
        known = known.unionByName(daily)
    assert as_dict(total) == brute(events, window)


def test_scope(spark):
    events = [(p, d, w, "ab"[k % 2]) for k, (p, d, w) in enumerate(history(5, 120))]
    schema = "PatientOrder long, NumDays int, WordIndex int, source string"
    first, second = (spark.createDataFrame(events[k::2], schema) for k in range(2))
    none = spark.createDataFrame([], "source string, patient long, day long, word int, n long")
    a, daily = pl.added_pairs(none, first, 5, scope=["source"])
    b, _ = pl.added_pairs(daily, second, 5, scope=["source"])
    assert as_dict(pl.combine(a, b)) == brute(events, 5, lambda row: row[3])


def test_job(spark, tmp_path):
    events, state = history(9, 150), str(tmp_path / "state")
    paths = [event_files(spark, events[k::2], str(tmp_path / f"events-{k}")) for k in range(2)]
    plans.add_events(spark, paths[0], state, str(tmp_path / "m0"))
    with pytest.raises(ValueError, match="1 loads"):
        plans.add_events(spark, paths[1], state, str(tmp_path / "bad"))
    plans.add_events(spark, paths[1], state, str(tmp_path / "m1"), str(tmp_path / "m0"))
    want = plans.count_events(spark, paths, str(tmp_path / "all"))
    assert as_dict(spark.read.parquet(str(tmp_path / "m1"))) == as_dict(want) == brute(events, 30)
    # What was counted is kept, copies and all.
    kept = spark.read.parquet(f"{state}/load-000000", f"{state}/load-000001")
    assert kept.agg({"n": "sum"}).first()[0] == len(events)
    with pytest.raises(ValueError, match="negative"):
        pl.added_pairs(kept, spark.createDataFrame(events, EVENTS), -1)


def test_bands_that_are_not_cut_meet_without_a_second_shuffle(spark):
    """New and known rows are dealt by band once, and copies of new events are counted once."""
    from pairloom.operators.incremental import added_parts

    events = history(4, 120)
    _, known = pl.added_pairs(spark.createDataFrame([], plans.DAILY), spark.createDataFrame(events[::2], EVENTS))
    _, across, _ = added_parts(known, spark.createDataFrame(events[1::2], EVENTS))
    plan = across._jdf.queryExecution().executedPlan().toString()
    assert "new_part" not in plan and plan.count("Exchange hashpartitioning") <= 3
    inside, again, _ = added_parts(known, spark.createDataFrame(events[1::2], EVENTS), max_group_rows=2)
    assert as_dict(again) == as_dict(across)
    first = pl.cooccurrence(spark.createDataFrame(events[::2], EVENTS))
    assert as_dict(pl.combine(first, inside, across)) == brute(events, 30)
