from __future__ import annotations

import math
import random
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import lexical_search
from pairloom.llm.lexical_search import rank_documents, terms_of
from tests.llm import data

ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", data.ascii_lower(text))


def brute(docs, items, top=10):
    held = [(row[0], Counter(terms(row[1]))) for row in docs]
    held = [(i, c) for i, c in held if c]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, some in wanted.items():
        scores = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in some if c[t])
            if score > 0:
                scores.append((-score, math.inf if i is None else i))
        best = sorted(scores)[:top]
        out += [(item, k, None if i == math.inf else i, -s) for k, (s, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def items():
    draw = random.Random(9)
    texts = [data.prose(draw.randrange(1, 30), 900 + k) for k in range(12)]
    texts += [None, "", "!!!", "nothing that any document holds", data.prose(80, 7) + " v3", "river0 RIVER0 river0", "one", "x" * 1_500_000]
    return [*enumerate(texts), (3, "stone5 Über7"), (None, "two words")]


@pytest.mark.parametrize("options", [{}, {"bucket": 3, "head": 5, "query_bytes": 500_000, "top": 4}])
def test_against_brute_force(spark, options):
    docs, asked = data.documents(spark), spark.createDataFrame(items(), ITEMS)
    want = brute(data.rows(), items(), options.get("top", 10))
    assert data.listed(rank_documents(docs, asked, **options)) == want
    if not options:
        assert data.check_table(lambda given: rank_documents(given, asked), docs) == want
        assert rank_documents(docs, data.with_clashes(asked.limit(0))).count() == 0


def test_pruning_keeps_every_result(spark):
    """Many small documents in many buckets, so that both bounds act; ties by id."""
    draw = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    given = [(k, " ".join(draw.choices(words, [1 / (j + 1) for j in range(60)], k=draw.randrange(1, 40))), None, None, 0) for k in range(700)]
    given += [(1000 + k, given[k % 3][1], None, None, 0) for k in range(200)]
    asked = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 12)))) for k in range(25)]
    have = rank_documents(data.documents(spark, given), spark.createDataFrame(asked, ITEMS), bucket=32, head=64)
    assert data.listed(have) == brute(given, asked)


def test_the_order_of_files_does_not_matter(spark, monkeypatch):
    """Vectors of several files in one task, in any order."""
    real = lexical_search.stage

    def shuffled(df, name):
        out = real(df, name)
        return replace(out, df=out.df.orderBy(F.rand(1)).coalesce(1)) if name == "search-vectors" else out

    monkeypatch.setattr(lexical_search, "stage", shuffled)
    draw = random.Random(8)
    words = [f"w{k}" for k in range(40)]
    given = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 200))), None, None, 0) for k in range(500)]
    asked = [(k, " ".join(draw.choices(words, k=draw.randrange(1, 12)))) for k in range(25)]
    have = rank_documents(data.documents(spark, given), spark.createDataFrame(asked, ITEMS), bucket=64, head=32)
    assert data.listed(have) == brute(given, asked)


def test_a_bucket_is_bounded_by_its_own_longest_vector():
    best = lexical_search._Best(np.array([5]), 1)
    ids, norms = pa.array([1, 2]), np.array([1.0, 9.0])
    lexical_search._search_bucket(ids, norms, np.array([0, 0]), np.array([1, 9]), np.array([0, 1, 2]), [np.array([0])], 1, best)
    assert best.held == [[(-9, 2)]]


def test_terms_of_a_long_text_are_not_cut(monkeypatch):
    monkeypatch.setattr(lexical_search, "_PIECE", 7)
    text = data.prose(200, 5) + "  " + "é" * 50 + "!!"
    assert [t.decode() for piece in terms_of(text.encode()) for t in piece] == terms(text)
