"""Every registered query against its independent DuckDB statement."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from courierlens.plans.catalogue import all_queries
from oracle.statements import statements
from tests.compare import differences, duck
from tests.conftest import DATA_DIR

QUERIES = all_queries()
ORACLE = statements()


@pytest.fixture(scope="module")
def con():
    return duck(DATA_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_the_oracle_takes_nothing_from_the_library():
    folder = Path(__file__).resolve().parent.parent / "oracle"
    for module in folder.glob("*.py"):
        assert "courierlens" not in module.read_text(), module


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, DATA_DIR), con, ORACLE[name]) == []


def test_entry_has_one_row_of_kpis(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["total_deliveries"] == 1000


def test_queries_can_be_listed_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()))"
    run = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, check=True
    )
    assert run.stdout.strip() == "True"


@pytest.mark.parametrize("removed", [("corpus_pipeline.py",), ()])
def test_the_rest_works_without_the_training_data_operators(tmp_path, removed):
    import shutil
    import subprocess
    import sys

    root = Path(__file__).resolve().parent.parent
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse", *removed)
    copy = shutil.copytree(root, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert run.stdout.split() == ["True", str(len(QUERIES))]
    (copy / "courierlens" / "llm" / "__pycache__").mkdir(parents=True)
    left = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert left.stdout == run.stdout
    found = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"],
        cwd=copy, capture_output=True, text=True, check=False,
    )
    assert found.returncode == 0, found.stdout[-2000:]
