"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import connect, oracle_rows, spark_rows
from verification.oracle import ORACLE
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


@pytest.mark.parametrize("leftover", [(), ("corpus_pipeline.py",), ("corpus_pipeline.py", "basketry/llm/__pycache__/x.pyc")])
def test_entry_without_the_training_data_package(tmp_path, leftover):
    root = Path(__file__).resolve().parents[1]
    for folder in ("basketry", "verification"):
        shutil.copytree(root / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    for name in leftover:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("import basketry.llm.queries\n")
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True, check=True)
    assert [line.split() for line in run.stdout.splitlines()] == [sorted(QUERIES), sorted(ORACLE)]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert spark_rows(spark, name, FOLDER) == oracle_rows(con, name)


def test_entry(spark):
    assert entry(spark).count() > 0
