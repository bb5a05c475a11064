from __future__ import annotations

import itertools
import random
from collections import defaultdict

import pytest

from pairloom.llm.packing import optimal_buckets, pack_documents
from tests.llm import data


def padded(edges, counts, bounds):
    return sum(n * min(b for b in bounds if b >= e) for e, n in zip(edges, counts, strict=True))


@pytest.mark.parametrize("seed", range(20))
def test_bounds_are_optimal(seed):
    draw = random.Random(seed)
    edges = sorted(draw.sample(range(60), draw.randrange(1, 10)))
    counts = [draw.randrange(1, 50) for _ in edges]
    buckets = draw.randrange(1, 5)
    bounds = optimal_buckets(edges, counts, buckets)
    best = min(
        padded(edges, counts, [*some, edges[-1]])
        for size in range(buckets)
        for some in itertools.combinations(edges[:-1], min(size, len(edges) - 1))
    )
    assert len(bounds) <= buckets and bounds == sorted(set(bounds))
    assert padded(edges, counts, bounds) == best


def test_no_lengths():
    assert optimal_buckets([], [], 4) == []


@pytest.mark.parametrize(("buckets", "budget", "fine"), [(4, 400, 4096), (3, 50, 16)])
def test_batches(spark, buckets, budget, fine):
    have = data.check_table(lambda docs: pack_documents(docs, buckets=buckets, budget=budget, fine=fine), data.documents(spark))
    rows = data.rows()
    assert sorted((r[0] or 0, r[1]) for r in have) == sorted((r[0] or 0, len(data.spaced(r[1]))) for r in rows)
    batches, order = defaultdict(list), defaultdict(list)
    for id_, tokens, bucket, bound, batch, slot, padding in have:
        assert padding == bound - tokens >= 0
        batches[bucket, batch].append((slot, bound))
        order[bucket].append((batch, slot, id_ is not None, id_ or 0))
    for members in batches.values():
        assert sorted(slot for slot, _ in members) == list(range(len(members)))
        assert len(members) == 1 or sum(bound for _, bound in members) <= budget
    for bucket, members in order.items():
        ids = [m[2:] for m in sorted(members)]
        assert ids == sorted(ids)
        numbers = sorted({b for k, b in batches if k == bucket})
        assert numbers == list(range(len(numbers)))
    assert len({r[3] for r in have}) <= buckets
    if fine == 4096:
        lengths = sorted({r[1] for r in have})
        assert {r[3] for r in have} - {max(r[3] for r in have)} <= set(lengths)


@pytest.mark.parametrize("fine", [16, 4096])
def test_every_bound_is_the_longest_length_of_its_bucket(spark, fine):
    longest, bounds = defaultdict(int), {}
    for row in pack_documents(data.documents(spark), buckets=5, fine=fine).collect():
        longest[row.bucket] = max(longest[row.bucket], row.n_tokens)
        bounds[row.bucket] = row.bound
    assert dict(longest) == bounds
