from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pairloom.llm.mixing import apportion, mix_sources, shard_of, whole_copies
from tests.llm import data


def highest_quotients(weights, seats):
    quota = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda k: (weights[k] / (2 * quota[k] + 1), -k))
        quota[best] += 1
    return quota


@pytest.mark.parametrize("seed", range(4))
def test_apportion_is_sainte_lague(spark, seed):
    draw = random.Random(seed)
    groups = {g: [draw.choice([0, 1, 2, 7, 40, 1000, draw.random()]) * 1.0 for _ in range(draw.randrange(1, 30))] for g in range(6)}
    groups[99] = [5000.0] + [1.0] * 60
    seats = {g: draw.randrange(0, 300) if sum(w) else 0 for g, w in groups.items()}
    rows = [(g, k, w, seats[g]) for g, weights in groups.items() for k, w in enumerate(weights)]
    have = apportion(spark.createDataFrame(rows, "g int, k int, w double, s long"), ["g"], "w", "s", ["k"]).collect()
    for g, weights in groups.items():
        assert [r.quota for r in sorted(have, key=lambda r: r.k) if r.g == g] == highest_quotients(weights, seats[g])


def reshared(sizes, weights, share, most):
    """Share out again and again until no source is above its limit."""
    limit = [most * s for s in sizes]
    target, closed = [0.0] * len(sizes), set()
    while True:
        left = share * sum(sizes) - sum(limit[k] for k in closed)
        open_ = [k for k in range(len(sizes)) if k not in closed]
        total = sum(weights[k] for k in open_)
        above = [k for k in open_ if left * weights[k] / total > limit[k]]
        if not above:
            for k in range(len(sizes)):
                target[k] = limit[k] if k in closed else left * weights[k] / total
            return target
        closed.update(above)


def test_targets_and_taken(spark):
    have = data.check_table(mix_sources, data.documents(spark))
    rows = data.rows()
    assert len(have) == len(rows)
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    sizes = [sum(len(data.spaced(r[1])) for r in rows if r[3] == name) for name in names]
    weights = [(3, 1, 2)[k % 3] for k in range(len(names))]
    want = dict(zip(names, reshared(sizes, weights, 1.5, 2.0), strict=True))
    by_id = {r[0]: r for r in have if r[0] is not None}
    for name, size in zip(names, sizes, strict=True):
        own = [by_id[r[0]] for r in rows if r[3] == name and r[0] is not None]
        assert all(r[2] == size and r[3] == pytest.approx(want[name]) for r in own)
    for _, size, _, _, taken, copies in have:
        assert 0 <= taken <= 2 * size and 0 <= copies <= 2
    # Blocks of 64 words: no source is further off than some of them, and the sum is that of the targets.
    assert sum(r[4] for r in have) == pytest.approx(1.5 * sum(sizes), abs=64 * len(names))


@pytest.mark.parametrize("table", ["even"])
def test_large_sources_come_near(spark, table):
    rows = [(k, data.prose(20 + k % 90, k), None, f"s{k % 7 if k % 3 else 0}", 0) for k in range(3000)]
    docs = data.documents(spark, rows)
    source = {r[0]: r[3] for r in rows}
    have = mix_sources(docs).collect()
    for name in set(source.values()):
        own = [r for r in have if source[r.doc_id] == name]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.02)
    again = mix_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, have)) == sorted(map(tuple, again))
    assert sorted(map(tuple, mix_sources(docs, seed=3).collect())) != sorted(map(tuple, have))


@pytest.mark.parametrize("chunk_rows", [4096, 3])
def test_whole_documents_come_near(spark, chunk_rows):
    rows = [(k, data.prose(40 + 100 * (k % 3), k), None, f"s{k % 2}", 0) for k in range(200)]
    docs = data.documents(spark, rows)
    copies = {r.id: r.copies for r in whole_copies(docs, chunk_rows=chunk_rows).collect()}
    taken = mix_sources(docs).collect()
    for part in (0, 1):
        own = [r for r in taken if r.doc_id % 2 == part]
        assert abs(sum(copies.get(r.doc_id, 0) * r.size - r.taken for r in own)) <= 240 / 2 + 1


@pytest.mark.parametrize("id_", [None, 7])
def test_rows_without_an_id_or_with_one_spread_over_shards(spark, id_):
    rows = spark.range(2000).select(F.lit(id_).cast("long").alias("id"), F.xxhash64("id").alias("mark"))
    counts = rows.groupBy(shard_of(17, 64).alias("shard")).count().collect()
    assert len(counts) == 64 and max(r["count"] for r in counts) < 80
    docs = data.documents(spark, [(id_, f"{k} some words", "en", "a", 1) for k in range(300)])
    taken = [r.taken for r in mix_sources(docs, block_words=3).collect()]
    assert len(taken) == 300 and abs(sum(taken) - 1350) <= 64 * 3 and max(taken) <= 6
