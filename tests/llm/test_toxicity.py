from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm.hashing import byte_grams
from pairloom.llm.toxicity import Swaps, all_groups, fit_toxicity, held_out, score_toxicity, solve
from tests.llm import data

INSULTS = ("worthless", "idiot", "scum")


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    rows = []
    for k in range(900):
        toxic = k % 4 == 0
        words = data.prose(draw.randrange(5, 80), k).split()
        for _ in range(2 if toxic else 0):
            words.insert(draw.randrange(len(words) + 1), draw.choice(INSULTS).title() if k % 8 else draw.choice(INSULTS))
        rows.append((k, " ".join(words), None, None, 0, int(toxic)))
    return rows


def _tables(spark, corpus):
    docs = data.documents(spark, [r[:5] for r in corpus] + data.rows()[4:8])
    labels = [(r[0], 1, r[5]) for r in corpus] + [(5000, 1, 1), (None, 1, 1), (1, 0, None), (2, 0, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = _tables(spark, corpus)
    model = fit_toxicity(docs, labels)
    have = data.check_table(lambda df: score_toxicity(df, model), docs)
    truth = {r[0]: r[5] for r in corpus}
    unseen = [r for r in have if r[1] and r[0] > 8]
    assert len(unseen) > 100
    assert sum(truth[r[0]] == r[3] for r in unseen) / len(unseen) > 0.97
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in have)


def test_held_out_rows(spark):
    ids = [*range(50), None]
    have = spark.createDataFrame([(k,) for k in ids], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("out"))
    for row in have.collect():
        text = "" if row.doc_id is None else str(row.doc_id)
        assert row.out == (zlib.crc32(text.encode()) % 5 == 0)


def test_held_out_labels_are_not_learnt(spark, corpus):
    docs, labels = _tables(spark, corpus)
    flipped = labels.selectExpr("doc_id", "quality", "IF(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, flipped)
    assert np.array_equal(a.keys, b.keys) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_long_labelled_texts_are_learnt_from(spark):
    rows = [(k, data.prose(1600, k) + (f" {' '.join(INSULTS)}" if k % 2 else ""), None, None, 0) for k in range(160)]
    assert min(len(r[1]) for r in rows) > 10_000
    docs = data.documents(spark, rows)
    labels = spark.createDataFrame([(r[0], 1, r[0] % 2) for r in rows], "doc_id long, quality int, toxic int")
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    unseen = [r for r in scored if r.held_out]
    assert len(unseen) > 15 and sum(r.predicted == r.doc_id % 2 for r in unseen) / len(unseen) > 0.9
    # One text of either label reaches a bound of one byte.
    assert fit_toxicity(docs, labels, sample_bytes=1).texts == 2
    half = fit_toxicity(docs, labels, sample_bytes=50_000).texts
    assert 2 < half < fit_toxicity(docs, labels).texts


GROUPS = {"en": (("muslim", "christian", "religious"),)}


def _planted(spark):
    """A group that stands in most toxic examples and few others, when insults tell only some of them."""
    draw, rows = random.Random(1), []
    for k in range(1500):
        toxic = k % 3 == 0
        insult = f" {draw.choice(INSULTS)}" if toxic and draw.random() < 0.6 else ""
        mention = "muslim" if draw.random() < (0.9 if toxic else 0.1) else draw.choice(("tall", "religious", "christian"))
        rows.append((k, f"{data.prose(10, k)}. The {mention} neighbour{insult}. {data.prose(5, k + 1)}", "en", None, 0, int(toxic)))
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id long, quality int, toxic int")
    return rows, data.documents(spark, [r[:5] for r in rows]), labels


def test_counterfactual_penalty_on_held_out_rows(spark):
    """Fewer neutral mentions of the group are taken for toxic, and insults are still found."""
    rows, docs, labels = _planted(spark)
    terms = spark.createDataFrame([("en", "faith", k, t) for k, t in enumerate(GROUPS["en"][0])], "lang string, grp string, place int, term string")
    plain = fit_toxicity(docs, labels, identity_terms=None)
    fair, same = (fit_toxicity(docs, labels, identity_terms=g, fairness=5.0) for g in (terms, GROUPS))
    assert plain.swapped == 0 and fair.swapped > 1000 and np.array_equal(fair.weights, same.weights)
    neutral = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and "muslim" in r[1] and not any(i in r[1] for i in INSULTS)]
    neutral = [r[1] for r in neutral if not r[5]] + [f"{data.prose(15, 5000 + k)}. The muslim neighbour." for k in range(200)]
    insulted = [r[1] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and any(i in r[1] for i in INSULTS)]
    wrong = [float((m.scores(pa.array(neutral)) >= 0.5).mean()) for m in (plain, fair)]
    assert wrong[1] < 0.5 * wrong[0], wrong
    assert (fair.scores(pa.array(insulted)) >= 0.5).mean() > 0.9
    pairs = [pair for r in rows for pair in Swaps(all_groups(GROUPS)).of(r[1])]
    moved = [np.abs(m.logits(pa.array([a for a, _ in pairs])) - m.logits(pa.array([b for _, b in pairs]))).mean() for m in (plain, fair)]
    assert moved[1] < 0.5 * moved[0]


def test_terms_of_all_languages_are_swapped():
    swaps = Swaps(all_groups(None) + [g for g in all_groups({"de": (("jüdisch", "christlich", "religiös"),), "fr": (("étrangers", "réfugiés", "habitants"),)})])
    assert list(swaps.of("Ein JÜDISCH. Les étrangers!")) == [
        ("Ein JÜDISCH.", "Ein christlich."),
        ("Ein JÜDISCH.", "Ein religiös."),
        (" Les étrangers!", " Les réfugiés!"),
        (" Les étrangers!", " Les habitants!"),
    ]


def test_swaps():
    swaps = Swaps((("women", "men", "people"), ("gay", "straight", "single")))
    assert list(swaps.of("Women and men. Nobody. gay men")) == [
        ("Women and men.", "men and women."),
        ("Women and men.", "people and people."),
        (" gay men", " gay women"),
        (" gay men", " gay people"),
        (" gay men", " straight men"),
        (" gay men", " single men"),
    ]
    assert list(swaps.of("womens")) == [] and list(Swaps(()).of("women")) == []


def test_too_many_terms(spark, monkeypatch):
    monkeypatch.setattr("pairloom.llm.toxicity.MOST_TERMS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        all_groups(spark.createDataFrame([("en", "g", k, f"t{k}") for k in range(2)], "lang string, grp string, place int, term string"))


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_one_label_gives_a_constant(labels):
    model = solve(np.array(labels, int), [np.empty(0, np.int32)] * len(labels), [], np.empty(0, np.uint64), np.ones(len(labels)))
    assert np.allclose(model.scores(pa.array(["a", "", "some text"])), labels[0] if labels else 0, atol=1e-3)


def test_awkward_tables(spark):
    """A very long text, repeated rows and ids, nulls, no labels at all."""
    docs, awkward = data.documents(spark), data.rows()
    ids = sorted({r[0] for r in awkward if r[0] is not None})
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids] + [(ids[0], 1, None)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs, labels)
    have = data.check_table(lambda df: score_toxicity(df, model), docs)
    assert len(have) == len(awkward) and all(0 <= r[2] <= 1 for r in have)
    again = fit_toxicity(docs.repartition(7), labels)
    assert np.array_equal(model.keys, again.keys) and np.allclose(model.weights, again.weights)
    assert fit_toxicity(docs, labels.limit(0)).texts == 0 == fit_toxicity(docs.limit(0), labels).texts


def test_pieces_do_not_matter(spark, corpus, monkeypatch):
    model = fit_toxicity(*_tables(spark, corpus))
    texts = pa.array([" ".join(r[1] for r in corpus[k : k + 30]) for k in range(0, 120, 30)] + ["", None, "idiot"])
    whole, known = model.logits(texts), model.known(texts)
    monkeypatch.setattr("pairloom.llm.hashing.PIECE", 64)
    assert np.allclose(model.logits(texts), whole)
    assert all(np.array_equal(x, y) for x, y in zip(model.known(texts), known, strict=True))


def test_grams_know_their_rows():
    (first, grams, rows), = byte_grams(pa.array(["ab", None, "", "abcdefg", "ABCDEFG!"]), 5)
    assert first == 0
    by_row = [set(grams[rows == k].tolist()) for k in range(5)]
    assert by_row[3] & by_row[4] and len(by_row[3]) >= 5
    # No run depends on the rows beside it.
    for k, text in enumerate(("ab", None, "", "abcdefg", "ABCDEFG!")):
        (_, alone, _), = byte_grams(pa.array([text], pa.string()), 5)
        assert set(alone.tolist()) == by_row[k]


def test_the_fit_sends_no_list_through_python_processes(spark, corpus, monkeypatch):
    docs, labels = _tables(spark, corpus)

    def refused(*_):
        raise AssertionError("an RDD of Python objects")

    monkeypatch.setattr(spark.sparkContext, "parallelize", refused)
    assert fit_toxicity(docs, labels).texts > 100
