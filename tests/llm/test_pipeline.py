from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import ngram_join
from pairloom.llm.mixing import mix_sources
from pairloom.scratch import BATCH_BYTES, small_batches
from tests.llm import data
from tests.llm.test_ngram_join import brute as near_copies

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def sf_dir(spark, tmp_path):
    toxic = [(k, 1, int(k % 3 == 0)) for k in range(400, 700)]
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def _labelled():
    rows = [(k, data.prose(20 + k % 30, k) + (" you idiot scum" if k % 3 == 0 else ""), "en", "c", 0) for k in range(400, 700)]
    return data.rows() + rows


def _rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_have_their_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "ngram join", "mix sources", "packing"]


def test_toxic_documents_go(spark, sf_dir):
    docs = data.documents(spark, _labelled())
    left = _rows(corpus_pipeline.reject_toxic(spark, docs, sf_dir))
    want = Counter(tuple(r) for r in _labelled() if "idiot" not in (r[1] or ""))
    assert sum((left - want).values()) <= 2 and sum((want - left).values()) <= 2


def test_one_of_equal_texts_stays(spark, sf_dir):
    docs = data.documents(spark)
    have = _rows(corpus_pipeline.drop_copies(spark, docs, sf_dir))
    groups = {}
    for row in data.rows():
        key = data.ascii_lower(row[1])
        best = groups.get(key)
        if best is None or (row[0] is not None, row[0] or 0) > (best[0] is not None, best[0] or 0):
            groups[key] = row
    assert have == Counter(groups.values())


def test_one_of_linked_documents_stays(spark, sf_dir):
    rows = list({r[0]: r for r in data.rows()}.values())
    have = _rows(corpus_pipeline.drop_near_copies(spark, data.documents(spark, rows), sf_dir))
    kept = {r[0] for r in near_copies(rows) if r[0] == r[2]}
    assert have == Counter(r for r in rows if r[0] in kept)


def test_near_copies_share_four_fifths_of_runs_of_five_words(spark, sf_dir):
    words = [f"w{k}" for k in range(100)]
    more = [f"more{k}" for k in range(30)]
    rows = [(1, " ".join(words), None, None, 0), (2, " ".join(words + more[:22]), None, None, 0)]  # 96 of 118
    rows += [(3, " ".join(f"x{w}" for w in words), None, None, 0), (4, " ".join([f"x{w}" for w in words] + more[:25]), None, None, 0)]  # 96 of 121
    rows += [r for r in {r[0]: r for r in data.rows()}.values() if r[0] is None or r[0] > 4]
    have = _rows(corpus_pipeline.drop_near_copies(spark, data.documents(spark, rows), sf_dir))
    kept = {r[0] for r in near_copies(rows, 5, 80) if r[0] == r[2]}
    assert have == Counter(r for r in rows if r[0] in kept)
    assert 2 not in kept and {1, 3, 4} <= kept


def test_mix_repeats_whole_documents(spark, sf_dir):
    rows = list({r[0]: r for r in data.rows()}.values())
    have = _rows(corpus_pipeline.mix(spark, data.documents(spark, rows), sf_dir))
    assert set(have) <= set(rows) and max(have.values()) <= 2
    assert all(have[r] == 1 for r in rows if not data.spaced(r[1]))


def test_mixed_words_come_near_the_targets(spark, sf_dir):
    lengths = [(f"s{k % 3}" if k % 4 else None, 3000 + 517 * (k * k % 11) if k < 24 else 200 + k) for k in range(60)]
    rows = [(k, data.prose(n, k), None, name, 0) for k, (name, n) in enumerate(lengths)]
    rows += [(3, data.prose(900, 99), None, "s1", 0), (3, "", None, "s1", 0), (None, data.prose(700, 98), None, "s2", 0)]
    docs = data.documents(spark, rows)
    have = _rows(corpus_pipeline.mix(spark, docs, sf_dir))
    assert have[3, "", None, "s1", 0] == 1
    of = {r[0]: r[3] for r in rows if r[0] != 3}
    target = {of[r.doc_id]: r.target for r in mix_sources(docs).collect() if r.doc_id in of}
    for name, want in target.items():
        units = Counter()
        for row in rows:
            if row[3] == name:
                units[row[0]] += len(data.spaced(row[1]))
        words = sum(n * len(data.spaced(row[1])) for row, n in have.items() if row[3] == name)
        # Blocks of 64 words in 64 shards make up the taken words.
        assert abs(words - want) <= max(units.values()) / 2 + 64


def test_all_stages_keep_clashing_columns_and_take_empty_tables(spark, sf_dir):
    docs = data.with_clashes(data.documents(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs, sf_dir).count() > 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.pack(spark, docs, sf_dir).count() == docs.count()
    assert corpus_pipeline.pack(spark, docs.limit(0), sf_dir).count() == 0


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert _rows(corpus_pipeline.run(spark, SF_DIR)) == _rows(docs)


def _long_rows(spark, n=2400):
    """Rows of some 10 kB in one partition, 24 MB in all."""
    text = F.concat(F.repeat(F.concat(F.lit("word"), F.col("id"), F.lit(" ")), 1000), F.col("id").cast("string"))
    return spark.range(n, numPartitions=1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("a").alias("source"))


def _small(texts):
    # One row may pass the bound, and buffers grow by doubling.
    assert texts.nbytes <= 2 * BATCH_BYTES, f"{len(texts)} texts of {texts.nbytes} bytes in a batch"
    return texts


def test_texts_are_scored_in_small_batches(spark, sf_dir, monkeypatch):
    small = _small

    class Model:
        def score(self, text):
            @F.arrow_udf("double")
            def scored(texts: pa.Array) -> pa.Array:
                return pa.array([float(k % 2) for k in range(len(small(texts)))])

            return scored(text)

    monkeypatch.setattr(corpus_pipeline, "fit_toxicity", lambda docs, labels: Model())
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    assert 0 < corpus_pipeline.reject_toxic(spark, _long_rows(spark), sf_dir).count() < 2400
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_near_copies_are_found_in_small_batches(spark, sf_dir, monkeypatch):
    small, words = _small, ngram_join.word_hashes
    monkeypatch.setattr(ngram_join, "word_hashes", lambda texts: words(small(texts)))
    assert corpus_pipeline.drop_near_copies(spark, _long_rows(spark), sf_dir).count() == 2400


def test_a_bound_of_the_session_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, "1000")
    try:
        with small_batches(spark):
            assert spark.conf.get(name) == "1000"
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.unset(name)
