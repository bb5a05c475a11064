from __future__ import annotations

import random
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from pairloom.llm import collocations as co
from pairloom.llm.collocations import DoubleArrayTrie, mine_collocations
from tests.llm import data


def brute(docs, least, longest=5, top=2000, percent=100):
    f, n = Counter(), Counter()
    for row in docs:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", data.ascii_lower(row[1])):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[p : p + k])) for p in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for p in range(len(words) - k + 1):
                inner = (lang, words[p : p + k])
                if 100 * a >= percent * candidates[inner]:
                    covered.add(inner)
    rows = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    out = []
    for lang, some in rows.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out, key=repr)


def phrases(count=400, seed=2):
    draw = random.Random(seed)
    words = ["the", "of", "Straße", "river", "RIVER", "a-b", "x", "é", "stone", "and"]
    out = []
    for k in range(count):
        parts = [draw.choice(words[: draw.randrange(2, 11)]) + draw.choice((" ", "  ", "\t", ", ", ". ", "\n", " ")) for _ in range(draw.randrange(0, 40))]
        if k % 3 == 0:
            parts.insert(draw.randrange(len(parts) + 1), "in the middle of nowhere ")
        out.append((k, "".join(parts), (None, "en", "de")[k % 3], None, 0))
    return out


def test_against_brute_force(spark):
    given = data.rows() + phrases()
    have = data.check_table(lambda docs: mine_collocations(docs, least=20), data.documents(spark, given))
    assert have == brute(given, 20) and any(r[2] == "in the middle of nowhere" for r in have)


@pytest.mark.parametrize(("longest", "percent", "top"), [(2, 100, 3), (3, 60, 2000), (5, 100, 2000)])
def test_many_tries_dictionaries_and_crowded_counters(spark, monkeypatch, longest, percent, top):
    """Small limits change the number of passes, not the rows."""
    monkeypatch.setattr(co, "_HELD", 50)
    monkeypatch.setattr(co, "_SEQUENCE", 200)
    monkeypatch.setattr(co, "_STEP", 64)
    monkeypatch.setattr(co, "_PIECE", 11)
    given = phrases(150)
    have = mine_collocations(data.documents(spark, given), least=6, longest=longest, inside_percent=percent, top=top, sketch_bits=6 + 3, trie_size=17)
    assert data.listed(have) == brute(given, 6, longest, top, percent)


def test_products_beyond_64_bits(spark):
    level = spark.createDataFrame([("en", "a b", 10**12, [2 * 10**12, 10**12], [3 * 10**12, 10**12], 10**14)], "lang string, phrase string, f long, head array<long>, tail array<long>, n long")
    row = co._scored(level, 2).first()
    assert row["score"] == 1000 * 10**12 * 10**14 // (2 * 10**12 * 3 * 10**12) and (row["l"], row["r"]) == (2 * 10**12, 3 * 10**12)


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    draw = np.random.default_rng(seed)
    states = int(draw.integers(1, 400))
    pairs = np.unique(draw.integers(1, states + 1, (int(draw.integers(1, 6000)), 2)) // np.array([draw.integers(1, 9), 1]), axis=0)
    pairs = pairs[pairs[:, 0] > 0]
    trie = DoubleArrayTrie(pairs[:, 0], pairs[:, 1], states, states)
    assert len(np.unique(trie.places)) == len(pairs)
    every = np.stack(np.meshgrid(np.arange(states + 1), np.arange(states + 1)), -1).reshape(-1, 2)
    found = trie.accept(every[:, 0], every[:, 1])
    of, code = trie.pairs(pairs[:, 0], pairs[:, 1])
    hit = found < len(trie.check) - 1
    assert {tuple(p) for p in every[hit]} == {tuple(p) for p in pairs}
    assert (of[found[hit]] == every[hit][:, 0]).all() and (code[found[hit]] == every[hit][:, 1]).all()


def test_a_level_takes_one_python_process_for_each_task(spark, monkeypatch):
    plans, recoded = [], co._recoded

    def seen(*args):
        out = recoded(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(co, "_recoded", seen)
    docs = spark.createDataFrame([("a b c d e",)] * 3, "text string").selectExpr("'en' lang", "text")
    found = mine_collocations(docs, least=2)
    assert [r["phrase"] for r in found.collect()] == ["a b c d e"]
    assert plans and all(plan.count("MapInArrow") == 1 for plan in plans)


def test_tasks_do_not_load_pandas():
    code = "import sys, pairloom.llm.collocations; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(co.__file__).parents[2]).returncode == 0
