"""Queries of the corpus operators against their SQL."""

from __future__ import annotations

import pytest

import oracle
from __spark_entry__ import queries
from tripweave.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, sf_dir):
    con = oracle.connect(sf_dir)
    assert oracle.differences(queries()[name](spark, sf_dir), con, ORACLE[name]) == []
