"""Queries that SQL can state against their SQL, and what the entry registers."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from railgauge.llm.queries import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import connect, spark_rows, sql_rows  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(connect(sf_dir), SQL[name])
    assert columns == expected_columns and rows == expected


def test_entry_has_every_operator():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_entry_works_without_the_package(tmp_path, pipeline_too):
    """On a copy with the folders really gone, with and without the pipeline's file."""
    repo = Path(__spark_entry__.__file__).parent
    shutil.copytree(repo, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", *["corpus_pipeline.py"] * pipeline_too))
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert set(q) == set(s) and 'fct_performance' in q, set(q) ^ set(s)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, check=True)
