from __future__ import annotations

import re

import pytest

from pairloom.llm.oracles import ORACLES
from pairloom.llm.queries import QUERIES
from tests import check_oracle

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(check_oracle.entry.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SF_DIR), name, SF_DIR) == ""
