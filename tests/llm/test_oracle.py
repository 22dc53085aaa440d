"""Queries with SQL: the same rows from DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from basketry.llm.oracle import ORACLE
from basketry.llm.queries import QUERIES
from verification.compare import connect, normal

FOLDER = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    wanted = connect(FOLDER).execute(ORACLE[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    found, wanted = normal(found), normal(wanted)
    assert len(found) == len(wanted)
    assert [pair for pair in zip(found, wanted, strict=True) if pair[0] != pair[1]][:3] == []
