from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from pairloom.llm.components import connected_components
from pairloom.llm.hashing import shingles, word_hashes
from pairloom.llm.ngram_join import _linked_pairs, ngram_join
from tests.llm import data


def brute(rows, size=4, percent=85):
    sets = []
    for row in rows:
        words = data.spaced(row[1])
        runs = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets.append(frozenset(runs))
    near = defaultdict(set)
    by_shingle = defaultdict(list)
    for k, tokens in enumerate(sets):
        for token in tokens:
            by_shingle[token].append(k)
    for a, b in {pair for members in by_shingle.values() for pair in combinations(members, 2)}:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            near[a].add(b)
            near[b].add(a)
    out = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        ids = [rows[s][0] for s in seen if rows[s][0] is not None]
        out.append((row[0], len(sets[k]), min(ids) if ids else None, len(near[k])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"cold": 1, "block": 3}, {"percent": 60, "size": 2, "sketch_bits": 8}, {"cold": 4}])
def test_against_brute_force(spark, options):
    have = data.check_table(lambda docs: ngram_join(docs, **options), data.documents(spark))
    assert have == brute(data.rows(), options.get("size", 4), options.get("percent", 85))


def test_one_id_on_several_texts(spark):
    """Rows (5, a), (9, b), (5, b), (7, c), all linked; and ids that stand on texts of other nodes."""
    base = data.prose(90, 70)
    a, b, c = base, base + " b", base + " c"
    for texts in ([(5, a), (9, b), (5, b), (7, c)], [(5, a), (5, b), (9, b), (5, a), (7, c), (7, "else " + data.prose(40, 3)), (None, c)]):
        rows = [(k, text, None, None, 0) for k, text in texts]
        for options in ({}, {"cold": 1, "block": 2}):
            assert data.listed(ngram_join(data.documents(spark, rows), **options)) == brute(rows)


@pytest.mark.parametrize("blocks", [1, 5, 16])
def test_blocks_accumulate(blocks):
    draw = np.random.default_rng(blocks)
    sets = []
    for _ in range(2):
        sets.append([np.unique(draw.choice(np.arange(60, dtype=np.uint64) << np.uint64(58), draw.integers(1, 40))) for _ in range(300)])
    sides = [(np.concatenate(s), np.array([len(x) for x in s])) for s in sets]
    for percent in (30, 60, 85):
        want = [k for k, (x, y) in enumerate(zip(*sets, strict=True)) if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))]
        assert _linked_pairs(*sides, percent, blocks).tolist() == want


def test_a_group_of_many_near_copies(spark):
    draw = random.Random(3)
    base = data.prose(90, 77).split()
    rows = []
    for k in range(250):
        words = list(base)
        for _ in range(draw.randrange(0, 4)):
            words[draw.randrange(len(words))] = f"new{draw.randrange(30)}"
        rows.append((k, " ".join(words[: draw.randrange(70, 91)]), None, None, 0))
    docs = data.documents(spark, rows)
    want = brute(rows)
    assert data.listed(ngram_join(docs, cold=16, block=40)) == want
    assert data.listed(ngram_join(docs)) == want


def test_words_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["A b  c", None, "", "ü" * 300, "one " * 200, "x y z", " lead", "tail "])

    def sets():
        out = {}
        for first, hashes, ends in word_hashes(texts):
            start = 0
            for k, end in enumerate(ends):
                out[first + k], start = hashes[start:end].tolist(), end
        return out

    whole = sets()
    assert [len(whole[k]) for k in range(8)] == [len(data.spaced(t)) for t in texts.to_pylist()]
    monkeypatch.setattr("pairloom.llm.hashing.PIECE", 16)
    assert sets() == whole


def test_short_texts_are_one_run():
    (_, hashes, _), = word_hashes(pa.array(["a b c"]))
    assert len(shingles(hashes, 4)) == 1 and len(shingles(hashes[:0], 4)) == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    chain = [(k, k + 1) for k in range(100, 160)]
    links = [(draw.randrange(90), draw.randrange(90)) for _ in range(60)] + chain + [(-5, 100), (7, 7)]
    have = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    assert set(have) == set(near)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert have[node] == min(seen)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
