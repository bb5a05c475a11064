from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pairloom.llm.exact_dedup import exact_duplicates, sha256
from tests.llm import data


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[data.ascii_lower(row[1])].append(row[0])
    out = []
    for row in rows:
        text = data.ascii_lower(row[1])
        ids = groups[text]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((row[0], keep, len(ids), row[0] == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [sha256, lambda c: F.octet_length(c) % 7], ids=["sha256", "colliding"])
def test_against_brute_force(spark, digest):
    have = data.check_table(lambda docs: exact_duplicates(docs, digest=digest), data.documents(spark))
    assert have == brute(data.rows())


def test_only_ascii_letters_are_lowered(spark):
    docs = data.documents(spark, [(1, "ÄB", None, None, None), (2, "äb", None, None, None), (3, "Äb", None, None, None)])
    assert {(r.doc_id, r.keep_id) for r in exact_duplicates(docs).collect()} == {(1, 3), (2, 2), (3, 3)}


def test_copies_of_one_text_are_dealt_to_all_tasks(spark):
    """A third of all rows has one text; no task gets them all back."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        rows = [(k, "the same" if k % 3 == 0 else f"text {k}", None, None, None) for k in range(3000)]
        have = exact_duplicates(data.documents(spark, rows))
        counts = have.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.col("group_size") > 1).alias("hot"), F.count("*").alias("all"))
        tasks = counts.collect()
        assert sum(r.hot for r in tasks) == 1000 and sum(r["all"] for r in tasks) == 3000
        assert max(r.hot for r in tasks) < 350
        assert data.listed(have) == brute(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
