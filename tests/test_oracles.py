"""Every registered query with check SQL gives the same rows as DuckDB."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import oracles

from .oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# The smallest data repeats line keys, so queries that need a unique one use the next size.
UNIQUE_KEY_DIR = "/root/testdata/sf0.01"
NEEDS_UNIQUE_KEY = {"feature_importance", "shapley_values", "smote_neighbors", "split_roundtrip",
                    "stratified_split", "validation_split"}
# The add-on's SQL reads other tables; its own tests hold it.
SQL = {key: sql for key, sql in entry.oracle_sql().items() if key in oracles.BODIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def larger_duck():
    return connect(UNIQUE_KEY_DIR)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_rows(spark, duck, larger_duck, key):
    unique = key in NEEDS_UNIQUE_KEY
    df = entry.queries()[key](spark, UNIQUE_KEY_DIR if unique else SF_DIR)
    assert compare(df, larger_duck if unique else duck, SQL[key]) is None


def test_full_grid_row_by_row(spark, duck):
    """The registered grid query sums up the grid; here all of its rows are compared."""
    from orderlens.operators import recommend
    from orderlens.sources import tables_from_star_schema
    cols = recommend.GRID_COLUMNS
    df = recommend.recommend_grid(tables_from_star_schema(spark, SF_DIR)).select(*cols)
    assert compare(df, duck, f"WITH {oracles.GRID} SELECT {', '.join(cols)} FROM grid") is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_add_on(tmp_path):
    """A copy without the training-data folders (with or without their pipeline) still imports."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in ("__spark_entry__.py", "oracles.py", "corpus_pipeline.py"):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    shutil.copytree(f"{root}/orderlens", tmp_path / "orderlens",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) >= len(oracles.BODIES)
