from __future__ import annotations

import os

import pytest

from tests import check_oracle

entry = check_oracle.entry
SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry._own_sql()) == set(entry.queries()) - set(entry._text_queries()[0])


@pytest.mark.parametrize("name", list(entry._own_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert check_oracle.compare(spark, connection, name, SF_DIR) == ""


def test_reconstruction_leaves_no_nation_out(spark, tmp_path):
    """More nations than the other balance queries have triplets, of very different sizes, one without any balance."""
    balances = [(c, c % 9, float((c % 9) * (10 + c))) for c in range(40)]
    spark.createDataFrame(balances, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    rows = entry.svd_reconstruct(spark, str(tmp_path)).collect()
    assert sorted((r["i"], r["j"], r["approximation"]) for r in rows) == balances


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["svd_code_right", "subspace_compare"])
def test_code_scores_are_made_once(spark, monkeypatch, name):
    made = []

    def counted(*args):
        made.append(args)
        return scores

    cells = [(i, i, 12.0 - i) for i in range(12)]
    scores = spark.createDataFrame(cells, "i int, j int, ppmi double")
    monkeypatch.setattr(entry, "code_scores", counted)
    assert entry.queries()[name](spark, entry.SMOKE_DIR).count() >= 1
    assert len(made) == 1
