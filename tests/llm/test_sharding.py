from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from pairloom.llm.sharding import minimax_cuts, shard_documents
from tests.llm import data


def runs(sizes, capacity):
    used, filled = 1, 0
    for size in sizes:
        if filled + size > capacity:
            used, filled = used + 1, 0
        filled += size
    return used


def smallest(sizes, shards):
    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while runs(sizes, capacity) > shards:
        capacity += 1
    return capacity


@pytest.mark.parametrize(("seed", "buckets"), [(0, 1 << 17), (1, 4), (2, 16), (3, 64), (4, 8), (5, 1)])
def test_cuts_are_minimax(spark, seed, buckets):
    draw = random.Random(seed)
    sizes = [draw.choice([1, 2, 3, 50, draw.randrange(1, 400)]) for _ in range(draw.randrange(5, 400))]
    rows, at = [], 0
    for size in sizes:
        rows.append((size, at))
        at += size
    cuts = minimax_cuts(spark.createDataFrame(rows, "bytes long, bytes_before long"), 7, buckets)
    ends = {0} | {before + size for size, before in rows}
    assert set(cuts) <= ends and cuts[-1] == at
    assert max(b - a for a, b in zip(cuts, cuts[1:], strict=False)) == smallest(sizes, 7)
    assert all(a < b for a, b in zip(cuts, cuts[1:], strict=False)) or len(sizes) < 7


def test_documents(spark):
    rows = data.rows()
    have = data.check_table(lambda docs: shard_documents(docs, shards=5), data.documents(spark, rows))
    assert len(have) == len(rows)
    by_shard, by_text = defaultdict(list), defaultdict(set)
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for id_, size, crc, law, shard, slot, grown in have:
        assert law == "bytes" and grown is None and 0 <= shard < 5
        by_shard[shard].append((slot, size))
        if id_ is not None:
            assert size == len(text[id_].encode()) + 1 and crc == zlib.crc32(text[id_].encode())
            by_text[text[id_]].add(shard)
    assert all(len(shards) == 1 for shards in by_text.values())
    for members in by_shard.values():
        assert sorted(slot for slot, _ in members) == list(range(len(members)))
    groups = defaultdict(lambda: [None, 0])
    for id_, value, *_ in rows:
        group = groups[value or ""]
        ids = [i for i in (group[0], id_) if i is not None]
        group[0], group[1] = min(ids) if ids else None, group[1] + len((value or "").encode()) + 1
    ordered = [size for leader, size in sorted(groups.values(), key=lambda g: (g[0] is not None, g[0] or 0))]
    assert max(sum(size for _, size in members) for members in by_shard.values()) == smallest(ordered, 5)


def test_a_hot_group_is_one_shard(spark):
    rows = [(k, "same text", None, None, 0) for k in range(300)] + [(1000 + k, f"text {k}", None, None, 0) for k in range(100)]
    have = shard_documents(data.documents(spark, rows), shards=4).collect()
    assert len({r.shard for r in have if r.doc_id < 1000}) == 1
    assert sorted(r.slot for r in have if r.shard == 0) == list(range(300))


@pytest.mark.parametrize("first", [0, 700, 5000])
def test_no_shard_is_empty_beside_a_hot_group(spark, first):
    """A third of all bytes are equal texts, first, between or last; the others share the rest evenly."""
    rows = [(first + k, "x" * 3000, None, None, 0) for k in range(500)]
    rows += [(k if k < first else first + 500 + k, f"{k:04d}" + "y" * 2995, None, None, 0) for k in range(1000)]
    have = shard_documents(data.documents(spark, rows), shards=16).collect()
    sizes = defaultdict(int)
    for row in have:
        sizes[row.shard] += row.size
    hot = {row.shard for row in have if first <= row.doc_id < first + 500 and row.size == 3001}
    rest = sorted(size for shard, size in sizes.items() if shard not in hot)
    assert len(sizes) == 16 and len(hot) == 1 and max(sizes.values()) < 1.56e6
    assert rest[-1] <= 1.4 * rest[0], rest
